"""Raw CSV input and CSV export."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructField, StructType

from ..schemas import SCHEMAS
from .quoted_lines import quoted_records

# Which file feeds which raw table.
RAW_FILES = {
    "customers.csv": "raw_customers",
    "products.csv": "raw_products",
    "orders.csv": "raw_orders",
    "order_items.csv": "raw_order_items",
}

# Cell texts that mean "no value", as documented for pandas.read_csv.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _typed(name: str, to: DataType) -> Column:
    """Cast a text column; text that is not a null marker and does not parse stops the job."""
    markers = ", ".join(f"'{text}'" for text in NULL_TEXTS)
    text = f"CASE WHEN `{name}` NOT IN ({markers}) THEN `{name}` END"
    if isinstance(to, StringType):
        return F.expr(text).alias(name)
    kind = to.simpleString()
    parsed = f"try_cast(`{name}` AS {kind})"
    if isinstance(to, IntegralType):  # 1.0 is what a whole number becomes in a column with gaps; 1.5 is refused
        number = f"try_cast(`{name}` AS decimal(38,10))"
        parsed = f"coalesce({parsed}, CASE WHEN {number} = floor({number}) THEN try_cast({number} AS {kind}) END)"
    failure = f"raise_error(concat('column {name}: not a {kind}: ', `{name}`))"
    return F.expr(f"CASE WHEN ({text}) IS NOT NULL THEN coalesce({parsed}, {failure}) END").alias(name)


def read_raw(spark: SparkSession, folder: str, table: str, line_breaks: bool = False) -> DataFrame:
    """One headered CSV as a typed raw table. Columns are matched by name, in any order.

    A column the file lacks is NULL; a column the table lacks is an error, as is a missing file. With
    `line_breaks` a quoted cell may hold line breaks; files are split all the same (see quoted_lines.py).
    """
    file = next(f for f, t in RAW_FILES.items() if t == table)
    path = f"{folder.rstrip('/')}/{file}"
    try:
        # Only the header line is read here: with every column text there is nothing to infer.
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"missing {path}") from error
        raise
    wanted = SCHEMAS[table]
    unknown = sorted(set(header) - set(wanted.names))
    if unknown:
        raise ValueError(f"{path}: columns not in {table}: {', '.join(unknown)}")
    as_text = StructType([StructField(name, StringType()) for name in header])
    # RFC 4180 quoting: quotes inside a quoted cell are doubled.
    if line_breaks:
        cells = F.from_csv("value", ", ".join(f"`{name}` string" for name in header), {"mode": "FAILFAST", "escape": '"'})
        rows = quoted_records(spark, path).select(cells.alias("row")).select("row.*")
    else:
        rows = spark.read.schema(as_text).options(header=True, mode="FAILFAST", escape='"').csv(path)
    return rows.select(
        *[
            _typed(f.name, f.dataType) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wanted
        ]
    )


def export_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Headered CSV, one file per partition, replacing what was there. `read_raw` takes compressed files as well."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path, compression=compression)
