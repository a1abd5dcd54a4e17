"""Ranked lexical search: the best documents of every item, by one scan of the documents with an automaton.

An Aho-Corasick automaton of all item terms, each between two guards (a blank before and after), runs over the
text with everything that is no term character turned into blanks: it finds the terms as whole words only, and
two neighbours share the blank between them. Its outputs are term numbers, which map to the items that hold
them; term frequencies come straight from the text, and documents are neither indexed, shuffled nor written.

The first scan counts documents, their lengths and the documents that hold each term; these give the weights.
The second scan scores: every task keeps the best `k` of each item (and only those: at most items x k rows), and
the tasks' rows are ranked once more. All is 64-bit whole numbers, so the order of the work does not matter.

Item terms are counted in Spark, so that repeated item rows are one row here, and reach the driver in blocks of
bounded size (`block_terms` pairs of item and term); every block takes two scans. The automaton of a block is what
is broadcast, as a list of its terms.

Defined cases: a NULL text has no terms; a document without terms is in no count and in no result. Rows that repeat
an item_id are one item with all their terms; an item without id or without terms has no result. Every document row
counts, repeated ones too, and may take ranks of its own; a document without id stands after all others of equal
score. Empty tables give an empty result. Long texts are scanned whole. Other columns do not matter.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

TOP = 10
BLOCK_TERMS = 1 << 18  # pairs of item and term in one block
SCORED_AT_ONCE = 1 << 22  # cells of documents by items
_SCALE = 1_000_000_000
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A-Z in lower case; other ASCII that is no digit or letter becomes a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_NO_ID = np.iinfo(np.int64).max  # stands for a NULL id


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, times) of all items."""
    terms = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(_TERM), F.lit(0))
    rows = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), F.explode(terms).alias("term"))
    return rows.groupBy("item_id", "term").agg(F.count("*").alias("times"))


class Scanner:
    """Term frequencies of texts; made in the worker from the list of terms."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.automaton.add_word(f" {term} ", number)
        self.automaton.make_automaton()

    def __call__(self, text: str) -> tuple[int, Counter]:
        """The number of all terms of `text`, and the frequencies of the item terms by number."""
        plain = text.encode("utf-8", "surrogatepass").translate(_TABLE)
        guarded = f" {plain.decode('utf-8', 'surrogatepass')} "
        return len(plain.split()), Counter(map(itemgetter(1), self.automaton.iter(guarded)))


def count_terms(docs: DataFrame, shared, text_col: str = "text") -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and per item term (by number) the documents that hold it."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, totals = Scanner(shared.value), Counter()
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    n, often = scan(text.as_py())
                    totals[-1] += n > 0
                    totals[-2] += n
                    totals.update(often.keys())
        yield pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.int64()), pa.array(totals.values(), pa.int64())], ["term", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(of_batches, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.collect()}  # at most one row per term of the block
    return found.pop(-1, 0), found.pop(-2, 0), found


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The `k` best (score, id) of every item so far; equal scores by ascending id."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.zeros(items, np.int64)  # a score has to reach `least`
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        keep = place < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        last = place[keep] == self.k - 1
        self.least[self.item[last]] = self.score[last]


def _score(docs: DataFrame, shared, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score): of every task the best documents of each item of the block."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, starts, owners, times, n_items, documents, length = shared.value
        scan, best = Scanner(terms), Best(n_items, k)
        at_once = max(1, SCORED_AT_ONCE // max(1, n_items))
        parts: list[tuple] = []  # of each document: id, item terms, their parts of the score

        def settle() -> None:
            if not parts:
                return
            ids = np.array([p[0] for p in parts], np.int64)
            number = np.concatenate([p[1] for p in parts])
            gain = np.concatenate([p[2] for p in parts])
            row = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
            n = starts[number + 1] - starts[number]
            entry = np.repeat(starts[number], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            scores = np.zeros((len(parts), n_items), np.int64)
            np.add.at(scores.ravel(), np.repeat(row, n) * n_items + owners[entry], np.repeat(gain, n) * times[entry])
            doc, item = np.nonzero((scores > 0) & (scores >= best.least))
            best.add(item, scores[doc, item], ids[doc])
            parts.clear()

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                n, often = scan(text.as_py()) if text.is_valid else (0, {})
                if not often:
                    continue
                number = np.fromiter(often.keys(), np.int64, len(often))
                tf = np.fromiter(often.values(), np.int64, len(often))
                m = 100 - 75 + (75 * n * documents) // length
                parts.append((i.as_py() if i.is_valid else _NO_ID, number, weights[number] * ((_SCALE * tf) // (1000 * tf + 8 * m))))
                if len(parts) == at_once:
                    settle()
        settle()
        ids = pa.array(best.doc, mask=best.doc == _NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), ids, pa.array(best.score)], ["item", "doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(of_batches, "item long, doc_id long, score long")


def _ranked_block(docs: DataFrame, rows: list, kind, k: int, id_col: str, text_col: str) -> DataFrame:
    """The result for the items of one block; `rows` are its (item_id, term, times)."""
    spark = docs.sparkSession
    terms = sorted({r["term"] for r in rows})
    ids = sorted({r["item_id"] for r in rows})
    term_number, item_number = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
    pairs = np.array([(term_number[r["term"]], item_number[r["item_id"]], r["times"]) for r in rows], np.int64).reshape(-1, 3)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    starts = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    documents, length, held_by = count_terms(docs, spark.sparkContext.broadcast(terms), text_col)
    weights = np.array([weight(held_by.get(i, 0), documents) for i in range(len(terms))], np.int64)
    parts = (terms, weights, starts, pairs[:, 1].copy(), pairs[:, 2].copy(), len(ids), documents, length)
    found = _score(docs, spark.sparkContext.broadcast(parts), k, id_col, text_col)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """(item_id, rank, doc_id, score): of every item the `k` best documents with a score above 0."""
    kind = items.schema["item_id"].dataType.simpleString()
    terms = item_terms(items)
    size = terms.count()
    blocks = max(1, math.ceil(size / block_terms))
    result = None
    for block in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # about block_terms
        found = _ranked_block(docs, rows, kind, k, id_col, text_col) if rows else None
        if found is not None:
            result = found if result is None else result.unionByName(found)
    if result is None:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return result


def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return search(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet"))


_SQL_TERMS = f"unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}'))"
OP12_SQL = f"""
WITH wanted AS (
    SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_SQL_TERMS} AS term FROM benchmark) GROUP BY ALL
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, text FROM documents
), held AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, {_SQL_TERMS} AS term FROM docs) GROUP BY ALL
), lengths AS (
    SELECT row, sum(tf)::BIGINT AS n FROM held GROUP BY row
), totals AS (
    SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM lengths
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, totals GROUP BY term
), scored AS (
    SELECT i.item_id, h.row, sum(i.times * w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (25 + (75 * l.n * documents) // length))))::BIGINT AS score
    FROM wanted i JOIN held h USING (term) JOIN weights w USING (term) JOIN lengths l USING (row), totals
    GROUP BY i.item_id, h.row
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
    FROM scored JOIN docs USING (row) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
