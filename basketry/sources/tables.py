"""Parquet tables under one root folder, in versions, and their catalog names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from ..schemas import CLUSTERED_BY, KEYS, SCHEMAS, SLICED_BY, conform
from . import versions
from .versions import Part, Version

COMPRESSION = "zstd"  # of stored tables: they are written once and read often


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _paths(root: str, table: str, parts: list[Part]) -> list[str]:
    return [f"{table_path(root, table)}/data/{p.folder}" for p in parts]


def has_table(spark: SparkSession, root: str, table: str) -> bool:
    return table_version(spark, root, table) is not None


def table_version(spark: SparkSession, root: str, table: str) -> Version | None:
    return versions.current(spark, table_path(root, table))


def read_parts(spark: SparkSession, root: str, table: str, parts: list[Part]) -> DataFrame:
    if not parts:  # known to be empty when a query is planned, so that a first load is not shuffled to meet it
        return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])
    return spark.read.schema(SCHEMAS[table]).parquet(*_paths(root, table, parts))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current version of a table with its declared schema; an empty one if it was never written."""
    found = table_version(spark, root, table)
    return read_parts(spark, root, table, found.parts if found else [])


def slice_of(table: str) -> Column:
    """The name of the slice of `table` that a row belongs in; the empty slice has the rows without one."""
    return F.coalesce(F.expr(SLICED_BY[table]).cast("string"), F.lit("none"))


def write_parts(df: DataFrame, root: str, table: str) -> list[Part]:
    """Write rows as new parts that no version names yet: one, or one per slice with its range of keys."""
    spark, folder = df.sparkSession, versions.new_folder()
    path = f"{table_path(root, table)}/data/{folder}"
    rows, order = conform(df, table), CLUSTERED_BY.get(table, [])
    if order:
        rows = rows.repartitionByRange(*order)
    try:
        if table not in SLICED_BY:
            (rows.sortWithinPartitions(*order) if order else rows).write.parquet(path, compression=COMPRESSION)
            return [Part(folder)]
        # The slice comes first in the order, or the writer would sort once more, by the slice alone.
        rows = rows.withColumn("_slice", slice_of(table)).sortWithinPartitions("_slice", *order)
        rows.write.partitionBy("_slice").parquet(path, compression=COMPRESSION)
    except Exception:
        versions.delete(spark, path)
        raise
    names = sorted(n for n in versions.names_in(spark, path) if n.startswith("_slice="))
    if not names:
        return []
    stored = spark.read.schema(rows.schema).parquet(path)
    key = F.col(KEYS[table][0])
    if not isinstance(SCHEMAS[table][KEYS[table][0]].dataType, IntegralType):
        return [Part(f"{folder}/{n}", n.removeprefix("_slice=")) for n in names]
    spans = stored.groupBy("_slice").agg(F.min(key).alias("least"), F.max(key).alias("most")).collect()  # a row per slice
    return [Part(f"{folder}/_slice={r['_slice']}", r["_slice"], r["least"], r["most"]) for r in sorted(spans, key=lambda r: r["_slice"])]


def append_table(df: DataFrame, root: str, table: str, load: str | None = None) -> bool:
    """Add rows to a table. With the id of a load that is in the table already nothing happens; says if rows were added."""
    spark = df.sparkSession
    now = table_version(spark, root, table)
    if load is not None and now and load in now.loads:
        return False
    parts = write_parts(df, root, table)
    versions.commit(spark, table_path(root, table), now, (now.parts if now else []) + parts, (now.loads if now else []) + ([load] if load else []))
    return True


def replace_table(df: DataFrame, root: str, table: str, load: str | None = None) -> None:
    """Write a new version beside the current one, which `df` may read. One writer at a time; a second one is refused."""
    spark = df.sparkSession
    now = table_version(spark, root, table)
    versions.commit(spark, table_path(root, table), now, write_parts(df, root, table), [load] if load else [])


def drop_table(spark: SparkSession, root: str, table: str) -> None:
    """Remove a table with all its versions; nothing to do if there is none."""
    versions.delete(spark, table_path(root, table))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Stop with `message` when there is not a single row."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def preview(df: DataFrame, rows: int = 2, order_by: str | None = None) -> DataFrame:
    """A few rows to look at: the first by a column, or any."""
    return (df.orderBy(order_by) if order_by else df).limit(rows)


def publish(spark: SparkSession, root: str, database: str = "retail") -> None:
    """Give the stored tables, and the cleaning views over them, names in the session's catalog, for plain SQL.

    A name stands for the version that is current now; publish again after new commits. A table in several
    folders is a view over them. Names outlive the session if its catalog does
    (`spark.sql.catalogImplementation`, a setting of the session). A view whose tables are not stored yet is
    left out.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    views = {r.viewName for r in spark.sql(f"SHOW VIEWS IN {database}").collect() if not r.isTemporary}
    stored = {t: found.parts for t in SCHEMAS if (found := table_version(spark, root, t))}
    for table, parts in stored.items():
        spark.sql(f"DROP {'VIEW' if table in views else 'TABLE'} IF EXISTS {database}.{table}")
        places = []
        for path in _paths(root, table, parts):
            hadoop_path, fs = versions.file_system(spark, path)
            places.append(fs.makeQualified(hadoop_path).toString())  # a relative one would be taken from the database's folder
        if len(places) == 1:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMAS[table])
            spark.sql(f"CREATE TABLE {database}.{table} ({columns}) USING parquet LOCATION '{places[0]}'")
            continue
        names = ", ".join(SCHEMAS[table].names)
        none = "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in SCHEMAS[table]) + " WHERE false"
        hadoop_path, fs = versions.file_system(spark, table_path(root, table))
        every = f"{fs.makeQualified(hadoop_path).toString()}/data/{{{','.join(p.folder for p in parts)}}}"  # one relation over all folders
        spark.sql(f"CREATE VIEW {database}.{table} AS " + (f"SELECT {names} FROM parquet.`{every}`" if parts else none))
    from ..plans.silver import VIEW_SQL

    for view, (needs, text) in VIEW_SQL.items():
        if all(table in stored for table in needs):
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS {text.format(schema=database + '.')}")
