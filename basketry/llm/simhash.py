"""Near-duplicate documents by SimHash fingerprints.

Fingerprints are 64 bits: bit i is set when more than half of the document's shingle hashes have it. Two
documents are linked when their fingerprints differ in at most `max_bits` bits; a component holds all that
links reach.

The search maps a fingerprint to its segment popcounts: 32 segments of two bits, each with a count of 0 to
2. The Manhattan distance of two such vectors never exceeds the bit distance, so all links lie within
Manhattan distance `max_bits`. The vectors are cut into groups of segments. At most `max_bits` groups of a
linked pair can differ, hence some choice of the other groups agrees exactly: those are the grid cells that
are joined, with the Manhattan distance and then the bit distance as join conditions. Counts are held in
thermometer form (0, 01, 11), in which the Manhattan distance is the number of differing bits.

Dense groups do not turn into all their pairs: every cell elects a few pivots, rows near a pivot link to it,
and only pairs without a common near pivot are joined. More groups make smaller cells; their number follows
from the number of fingerprints alone and does not change the result.

Defined cases: a NULL or empty text has no words and fingerprint zero, linked like any other. Fewer words
than a shingle: the whole sequence is the one shingle. A NULL doc_id is never a component_id; a component
of such rows only has NULL. Repeated rows each get a result. An empty table gives an empty result. Other
input columns do not matter, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = 32
PIVOTS = 4
CANDIDATES = 2000  # comparisons per fingerprint beyond which cells are made smaller
_BLOCK = 1 << 15  # shingles hashed at a time
_LOW = 0x5555555555555555


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        part = words[at : at + min(_BLOCK, n - at) + size - 1]
        shingles = [b" ".join(part)] if len(words) < size else map(b" ".join, zip(*[part[i:] for i in range(size)]))
        hashes = np.array([digest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((fingerprint(t.as_py(), size) for t in batch.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(of_batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def _with_fingerprint(rows: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(_row, _id, _fp) of rows that are one struct `_row`."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((fingerprint(t.as_py(), size) for t in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["_row", "_id", "_fp"])

    parts = rows.select("_row", F.col("_row")[id_col].alias("_id"), F.col("_row")[text_col].alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in parts.schema}
    return parts.mapInArrow(of_batches, f"_row {kinds['_row']}, _id {kinds['_id']}, _fp long")


def thermometer(fp: Column) -> Column:
    """Counts of the two-bit segments: 00, 01 or 11."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW)), fp.bitwiseAND(F.lit(_LOW))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseOR(low))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def group_masks(groups: int) -> list[int]:
    """Bit masks of the groups of segments, as signed longs."""
    edges = [2 * (SEGMENTS * i // groups) for i in range(groups + 1)]
    return [_signed((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]


def groups_for(n: int, max_bits: int = MAX_BITS) -> int:
    """Fewest groups with at most CANDIDATES expected comparisons per fingerprint among n unrelated ones."""
    for groups in range(max_bits + 2, SEGMENTS):
        agreeing = groups - max_bits
        if n * comb(groups, agreeing) * 0.375 ** (SEGMENTS * agreeing / groups) <= CANDIDATES:
            return groups
    return SEGMENTS


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS, groups: int | None = None) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints within `max_bits` bits; `fps` has one distinct column `fp`, n rows."""
    groups = groups or groups_for(n, max_bits)
    masks = group_masks(groups)
    signed32 = lambda bits: bits - (1 << 32) if bits >= 1 << 31 else bits
    chosen = list(combinations(range(groups), groups - max_bits))
    at = F.col("t")
    cells = F.array(
        *[
            F.struct(
                F.lit(signed32(sum(1 << g for g in own))).alias("own"),
                F.lit(signed32((1 << (own[-1] + 1)) - 1)).alias("upto"),
                at.bitwiseAND(F.lit(_signed(sum(masks[g] for g in own) % (1 << 64)))).alias("cell"),
            )
            for own in chosen
        ]
    )
    far = lambda x, y: F.bit_count(x.bitwiseXOR(y))
    rows = fps.select("fp", thermometer(F.col("fp")).alias("t")).select("fp", "t", F.explode(cells).alias("c")).select("fp", "t", "c.*")
    pivots = rows.groupBy("own", "cell").agg(
        F.count("*").alias("n"),
        *[F.min(F.struct(F.xxhash64("fp", F.lit(i)).alias("h"), "fp"))["fp"].alias(f"p{i}") for i in range(PIVOTS)],
    )
    near = F.lit(0)
    for i in range(PIVOTS):
        near = near + F.when(far(F.col("fp"), F.col(f"p{i}")) <= max_bits, 1 << i).otherwise(0)
    rows = rows.join(pivots.filter("n > 1"), ["own", "cell"]).withColumn("near", near)
    rows = stage(rows.drop("n"))
    to_pivots = [
        rows.filter(F.col("near").bitwiseAND(F.lit(1 << i)) != 0).filter(F.col("fp") != F.col(f"p{i}")).select(F.col("fp").alias("a"), F.col(f"p{i}").alias("b"))
        for i in range(PIVOTS)
    ]
    left = rows.select("own", "cell", "upto", *[F.col(c).alias(f"{c}_a") for c in ("fp", "t", "near")])
    right = rows.select(F.col("own").alias("own_b"), F.col("cell").alias("cell_b"), *[F.col(c).alias(f"{c}_b") for c in ("fp", "t", "near")])
    agreeing = F.lit(0)  # groups in which both have the same counts; a pair counts in its first cell only
    for g, mask in enumerate(masks):
        agreeing = agreeing + F.when(F.col("t_a").bitwiseXOR(F.col("t_b")).bitwiseAND(F.lit(mask)) == 0, signed32(1 << g)).otherwise(0)
    pairs = left.join(
        right,
        (F.col("own") == F.col("own_b"))
        & (F.col("cell") == F.col("cell_b"))
        & (F.col("fp_a") < F.col("fp_b"))
        & (F.col("near_a").bitwiseAND(F.col("near_b")) == 0)
        & (far(F.col("t_a"), F.col("t_b")) <= max_bits)
        & (far(F.col("fp_a"), F.col("fp_b")) <= max_bits)
        & (agreeing.bitwiseAND(F.col("upto")) == F.col("own")),
    ).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
    for more in to_pivots:
        pairs = pairs.union(more)
    return pairs


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    rows = stage(fingerprints(docs, id_col, text_col, size))
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct.select("fp"), distinct.count(), max_bits))
    grouped = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(grouped.join(smallest, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of every component, with all its columns: that with the smallest id, and of its rows the smallest fingerprint.

    Rows without an id cannot be told apart and stay. An id on several rows stands for each of them: a row goes for
    the component of its own text. Of rows equal in id and fingerprint one stays, any of them.
    """
    found = stage(near_duplicates(docs, id_col, text_col, size, max_bits))
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col)).distinct()
    repeated = found.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").count().filter("count > 1")
    repeated = stage(repeated.select(F.col("doc_id").alias(id_col)))
    if repeated.isEmpty():
        return docs.join(gone, id_col, "left_anti").select(*docs.columns)
    single = docs.join(gone.union(repeated), id_col, "left_anti").select(*docs.columns)
    # Rows that share an id are told apart by their fingerprint, taken once more for them alone.
    kept = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("component_id").agg(F.min("fp").alias("_fp"))
    again = docs.join(repeated, id_col, "left_semi").select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    again = _with_fingerprint(again, id_col, text_col, size).dropDuplicates(["_id", "_fp"])
    chosen = again.join(kept.select(F.col("component_id").alias("_id"), "_fp"), ["_id", "_fp"], "left_semi")
    return single.unionByName(chosen.select("_row.*"))


def op10_simhash(spark: SparkSession, d: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{d}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
