"""Queries of this package, and their SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_pairs import op5_byte_pairs
from .decontamination import op2_decontamination
from .html_extraction import op13_html_extraction
from .language_model import op4_language_model
from .lexical_search import OP12_SQL, op12_lexical_search
from .line_dedup import OP9_SQL, op9_line_dedup
from .personal_data import op6_personal_data
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .quality_classifier import op1_quality_classifier
from .quality_rules import op8_quality_rules
from .sharding import op3_sharding
from .simhash import op10_simhash
from .token_counts import op7_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_language_model": op4_language_model,
    "op5_byte_pairs": op5_byte_pairs,
    "op6_personal_data": op6_personal_data,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_html_extraction": op13_html_extraction,
}

ORACLES: dict[str, str] = {
    "op9_line_dedup": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
