"""Rows joined to a table with one row per key, where a key may hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SHARE = 64  # a key with more than 1/64 of all rows is split, so fewer than 64 are
SALTS = 32


def hot_keys(rows: DataFrame, key: str) -> list:
    """The keys with more than 1/SHARE of all rows that have one; counted on the map side."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    return [r[key] for r in counts.filter(F.col("count") * SHARE > total).collect()]  # fewer than SHARE rows


def join_spread(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` left-joined to `table` by `key`, with no key's rows in one task.

    Spark broadcasts `table` if it is measured to be small. If not, hot keys and rows without key are dealt out by a salt,
    and a hot key's row of `table` is copied to all its salts. `rows` is read twice; its order within a partition
    must not change from one reading to the next (a table, or a column-wise function of one).
    """
    hot = hot_keys(rows, key)
    split = lambda column: column.isin(hot) if hot else F.lit(False)
    dealt: Column = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    salted = rows.withColumn("_salt", F.when(F.col(key).isNull() | split(F.col(key)), dealt).otherwise(F.lit(0)))
    salts = F.when(split(F.col(key)), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return salted.join(table.withColumn("_salt", F.explode(salts)), [key, "_salt"], "left").drop("_salt")
