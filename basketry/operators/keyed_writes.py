"""Insert-or-update and insert-or-ignore by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are NULL in part or shared by several rows, with their row counts.

    Counting combines on the map side, so a key holding most rows costs one row per map task.
    """
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter((F.col("n_rows") > 1) | null_key)


def _refusals(batch: DataFrame, keys: list[str], what: str) -> DataFrame:
    """No rows, with the columns of `batch`; the job that reads it stops when a key is NULL or repeated.

    Only keys are grouped, by a hash aggregate that combines on the map side: a key with most rows is one row
    per map task. The message holds the count, so that the check cannot be moved below it.
    """
    found = key_violations(batch, keys)
    shown = F.concat(F.lit(f"{what} key ({', '.join(keys)}) is NULL or not unique: "), F.to_json(F.struct(*keys, "n_rows")))
    stopped = found.filter(F.when(F.col("n_rows") > 0, F.raise_error(shown).cast("string")).isNotNull())
    return stopped.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema])


def single_rows(batch: DataFrame, keys: list[str], what: str = "batch") -> DataFrame:
    """`batch` itself, stopping the job that reads it when a key is NULL or repeated.

    The rows are passed on as they come; the check beside them reads the keys only.
    """
    return batch.unionByName(_refusals(batch, keys, what))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """`target` with the rows of `batch` added, or put in place of the rows with the same key.

    A batch with a NULL key or the same key twice is refused when the result is computed: there is no right row
    to keep. The target's keys are unique. The target meets the keys of the batch, not its rows.
    """
    rows = batch.select(*target.columns)
    stays = target.join(batch.select(*keys), keys, "left_anti").select(*target.columns)
    return stays.unionByName(rows).unionByName(_refusals(rows, keys, "batch"))


def insert_new(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """`target` with the rows of `batch` whose key it does not hold; the smallest row of a repeated key.

    Repeated keys collapse on the map side before the join, however often one occurs.
    """
    rest = [c for c in target.columns if c not in keys]
    if rest:
        single = batch.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*")
    else:
        single = batch.select(*keys).distinct()
    fresh = single.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
