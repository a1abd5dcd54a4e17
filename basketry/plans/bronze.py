"""Raw rows to dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_name, month_name
from ..operators.keyed_writes import insert_new, single_rows, upsert
from ..schemas import KEYS, SLICED_BY, conform
from ..sources.csv_files import RAW_FILES, read_raw
from ..sources.staging import stage
from ..sources.tables import append_table, read_parts, read_table, replace_table, slice_of, table_path, table_version, write_parts
from ..sources.versions import commit


def load_id(spark: SparkSession, in_dir: str, file: str) -> str:
    """What tells a load from others: the number of lines of its file and sums of their hashes, in any order."""
    at = F.xxhash64("value")
    halves = (F.shiftrightunsigned(at, 32), at.bitwiseAND(F.lit(0xFFFFFFFF)))
    found = spark.read.text(f"{in_dir.rstrip('/')}/{file}").agg(F.count("*"), *[F.coalesce(F.sum(h), F.lit(0)) for h in halves]).first()
    return f"{file}-{found[0]}-{found[1]:x}-{found[2]:x}"


def load_raw(spark: SparkSession, in_dir: str, root: str, truncate: bool = False) -> None:
    """Load the four CSV files into the raw tables: added to what is there, or in its place.

    A table knows the loads that went in. A file with the lines of an earlier load is not added again, so a load
    that failed half-way, or whose job failed later, may simply be repeated.
    """
    frames = {file: read_raw(spark, in_dir, table) for file, table in RAW_FILES.items()}  # a missing file stops here
    for file, rows in frames.items():
        load = load_id(spark, in_dir, file)
        if not truncate:
            append_table(rows, root, RAW_FILES[file], load)
        elif not ((now := table_version(spark, root, RAW_FILES[file])) and now.loads == [load]):
            replace_table(rows, root, RAW_FILES[file], load)


def dimension_rows(raw: DataFrame, table: str) -> DataFrame:
    """Distinct raw rows of dim_customers or dim_products; a key with two different rows is refused."""
    return single_rows(conform(raw, table).distinct(), KEYS[table], table)


def date_rows(raw_orders: DataFrame) -> DataFrame:
    """One row per date that occurs in the orders."""
    day = F.col("date_key")
    dates = raw_orders.select(F.col("order_date").cast("date").alias("date_key")).filter(day.isNotNull()).distinct()
    return conform(
        dates.select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.weekofyear(day).alias("week"),
            day_name(day).alias("day_name"),
            month_name(day).alias("month_name"),
        ),
        "dim_date",
    )


def fact_rows(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows of fact_orders or fact_order_items; a repeated key is refused."""
    return single_rows(conform(raw, table), KEYS[table], table)


def upsert_table(batch: DataFrame, root: str, table: str) -> None:
    """Bring a batch into a stored table by its key.

    A table in slices keeps the files of all slices that neither get rows of the batch nor hold one of its keys. The
    latter are found by the slices' key ranges and then exactly, from the key column alone: a row whose slice
    changes (an order whose month is corrected) leaves the old one.
    """
    spark, keys, now = batch.sparkSession, KEYS[table], table_version(batch.sparkSession, root, table)
    if table not in SLICED_BY or now is None:
        replace_table(upsert(read_table(spark, root, table), batch, keys), root, table)
        return
    batch = conform(batch, table)
    key = F.col(keys[0])
    spans = batch.groupBy(slice_of(table).alias("slice")).agg(F.min(key).alias("least"), F.max(key).alias("most")).collect()
    touched = {r["slice"] for r in spans}  # a row per slice
    least = min((r["least"] for r in spans if r["least"] is not None), default=None)
    most = max((r["most"] for r in spans if r["most"] is not None), default=None)
    near = [p for p in now.parts if p.slice not in touched and p.least is not None and least is not None and p.least <= most and p.most >= least]
    if near:
        held = read_parts(spark, root, table, near).select(key, slice_of(table).alias("slice"))
        touched |= {r["slice"] for r in held.join(batch.select(key), keys, "left_semi").select("slice").distinct().collect()}
    rewritten = [p for p in now.parts if p.slice in touched]
    fresh = write_parts(upsert(read_parts(spark, root, table, rewritten), batch, keys), root, table)
    commit(spark, table_path(root, table), now, [p for p in now.parts if p.slice not in touched] + fresh, now.loads)


def build_dims(spark: SparkSession, root: str) -> None:
    for table in ("dim_customers", "dim_products"):
        batch = stage(conform(read_table(spark, root, table.replace("dim_", "raw_")), table).distinct())
        upsert_table(batch, root, table)
    dates = date_rows(read_table(spark, root, "raw_orders"))  # one scan of one column
    replace_table(insert_new(read_table(spark, root, "dim_date"), dates, KEYS["dim_date"]), root, "dim_date")


def build_facts(spark: SparkSession, root: str) -> None:
    for table in ("fact_orders", "fact_order_items"):
        upsert_table(read_table(spark, root, table.replace("fact_", "raw_")), root, table)
