"""Joins whose left side has keys that hold very many rows, without relying on adaptive execution.

Heavy keys are measured, not guessed: rows are counted by a hash bucket of the key, then the keys of the few buckets that
hold more than a partition's share are counted exactly. Both counts combine on the map side and read the key column only. Heavy
rows are dealt out by a salt over pieces well below a share, and the heavy keys' rows of the other side, which
has a row per key, are repeated for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BUCKETS = 4096
FINENESS = 8  # pieces per share: many small ones spread more evenly than few large ones


def heavy_keys(rows: DataFrame, key: str, partitions: int) -> list[tuple]:
    """(key, pieces) of the keys with more than half of an even share of `partitions`; fewer than twice that many."""
    keys = rows.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    bucket = F.pmod(F.xxhash64("k"), F.lit(BUCKETS))
    counts = {r["b"]: r["n"] for r in keys.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}  # BUCKETS rows
    share = sum(counts.values()) / (2 * partitions)
    full = [b for b, n in counts.items() if n > share]
    if not full or share * 2 * partitions < BUCKETS:  # few rows: nothing is heavy
        return []
    inside = keys.filter(bucket.isin(full)) if len(full) < BUCKETS // 4 else keys
    found = inside.groupBy("k").agg(F.count("*").alias("n")).filter(F.col("n") > share).collect()
    return sorted((r["k"], -int(-FINENESS * r["n"] // share)) for r in found)


def join_heavy(left: DataFrame, right: DataFrame, key: str, measured: DataFrame | None = None) -> DataFrame:
    """`left` joined to `right` (a row per key, or few) on `key`, heavy keys of `left` spread over several tasks.

    `measured` is a frame with the same keys that is cheaper to read than `left`. The salt is a hash of the left row,
    so a task that is run again deals its rows out as before.
    """
    spark = left.sparkSession
    heavy = heavy_keys(left if measured is None else measured, key, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not heavy:
        return left.join(right, key)
    kind = left.schema[key].dataType.simpleString()
    pieces = F.broadcast(spark.createDataFrame(heavy, f"{key} {kind}, _pieces long"))  # fewer rows than twice the partitions
    others = [c for c in left.columns if c != key]
    dealt = left.join(pieces, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*others), F.col("_pieces")), F.lit(0))).drop("_pieces")
    spread = right.join(pieces, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1).cast("long")) - 1)))
    return dealt.join(spread.drop("_pieces"), [key, "_salt"]).drop("_salt")
