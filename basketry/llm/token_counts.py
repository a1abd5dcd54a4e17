"""Token counts of whole texts without making their ids.

A text's token count is the sum of its pre-tokens' piece counts. The pieces of every distinct pre-token of
the corpus are counted once; the counts are joined to the pre-token frequencies of the documents and summed.
The most frequent pre-tokens are joined where the text is read, all others by a shuffle (see token_sums.py).

Defined cases: a NULL text is empty; an empty text has no bytes and no tokens. The vocabulary's special
tokens inside a text are cut out first and count as one token each. Repeated rows each get a result, NULL
ids are carried along. An empty table gives an empty result. Other columns do not matter, whatever their names.
Texts within Latin-1 are cut by `re`, twice as fast as `regex` and by the same classes; all others by `regex`.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from .token_sums import BLOCK_BYTES, BLOCK_ROWS, HEAD, token_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
_COUNTED_AT_ONCE = 10_000
_CLASSES = (r"\p{L}", r"\p{N}", r"\s", r"\S")  # in which `re` and `regex` differ, or that `re` lacks


def in_ranges(pattern: str) -> str | None:
    """`pattern` for texts within Latin-1, its character classes written out, as the standard library's faster `re` takes it.

    The ranges are what `regex` itself finds among these characters. None if anything else in the pattern might mean
    something different to `re`.
    """
    plain = pattern
    for name in _CLASSES:
        plain = plain.replace(name, "x")
    if set(plain) & set("\\{}&~-") or "[[" in pattern or re.search(r"\(\?(?![:=!])|\[\^?\]|[*+?][*+?]|\|\|", plain):
        return None
    every = "".join(map(chr, range(256)))

    def ranges(name: str) -> str:
        found = (m.span() for m in regex.finditer(f"{name}+", every))
        return "".join(rf"\x{start:02x}-\x{end - 1:02x}" for start, end in found)

    written = {name: ranges(name) for name in _CLASSES if name in pattern}
    made, inside, at = [], False, 0
    while at < len(pattern):
        name = next((n for n in written if pattern.startswith(n, at)), None)
        if name is None:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            made.append(pattern[at])
            at += 1
            continue
        made.append(written[name] if inside else f"[{written[name]}]")
        at += len(name)
    return "".join(made)


class _Splitter:
    """Pre-tokens of a text, and the special tokens cut out of it."""

    def __init__(self, vocabulary: str, pattern: str):
        with open(vocabulary, encoding="utf-8") as file:
            special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.any = regex.compile(pattern).findall
        written = in_ranges(pattern)
        self.latin = self.any if written is None else re.compile(written).findall

    def all(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.latin(text)

    def __call__(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self.all(text), 0
        parts = self.special.split(text)
        return [piece for part in parts for piece in self.all(part)], len(parts) - 1


def distinct_pretokens(texts: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(pretoken, n) of the one column of `texts`: every distinct one and how often it occurs."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["pretoken", "n"])

        split = _Splitter(vocabulary, pattern)
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py())[0])
                if len(seen) >= 1 << 19:
                    yield out()
                    seen = Counter()
        yield out()

    return texts.mapInArrow(of_batches, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))


def count_pieces(pretokens: DataFrame, vocabulary: str) -> DataFrame:
    """(token, value, n) of (pretoken, n): a pre-token, its pieces beyond the first, its frequency."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = Tokenizer.from_file(vocabulary)
        for batch in batches:
            for at in range(0, len(batch), _COUNTED_AT_ONCE):
                part = batch.column(0).slice(at, _COUNTED_AT_ONCE)
                found = model.encode_batch_fast(part.to_pylist(), add_special_tokens=False)
                more = pa.array([len(x) - 1 for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([part, more, batch.column(1).slice(at, _COUNTED_AT_ONCE)], ["token", "value", "n"])

    return pretokens.mapInArrow(of_batches, "token string, value long, n long")


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    pattern: str | None = None,
    limit: int = LIMIT,
    head: int = HEAD,
    block_bytes: int = BLOCK_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. `vocabulary` is a file that every executor can open."""
    vocabulary, pattern = vocabulary or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = count_pieces(distinct_pretokens(rows.select("text"), vocabulary, pattern), vocabulary)

    def of_texts() -> Callable[[pa.Array], tuple[list[list[str]], np.ndarray]]:
        split = _Splitter(vocabulary, pattern)

        def of_group(texts: pa.Array) -> tuple[list[list[str]], np.ndarray]:
            found, specials = zip(*[split(text.as_py()) for text in texts])
            return [*found], np.column_stack([pc.binary_length(texts).to_numpy(), np.add([*map(len, found)], specials)])

        return of_group

    found = token_sums(rows, of_texts, pieces, [(lambda more: more, F.col("value"))], None, head, block_bytes, block_rows)
    n_tokens = (F.col("numbers")[1] + F.col("s0")).cast("long")
    result = found.select("doc_id", F.col("numbers")[0].cast("long").alias("n_bytes"), n_tokens.alias("n_tokens"))
    return result.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{d}/documents.parquet"))
