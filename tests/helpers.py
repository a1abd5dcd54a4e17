"""What tests share beside fixtures."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from basketry.schemas import SCHEMAS

SF_DIR = "/root/testdata/sf0.001"
AS_OF = date(2024, 6, 30)


def frame(spark, table, rows):
    """Rows of `table` with money given as text and dates as ISO text."""
    def value(field, v):
        kind = field.dataType.simpleString()
        if v is None:
            return None
        if kind.startswith("decimal"):
            return Decimal(v)
        return date.fromisoformat(v) if kind == "date" and isinstance(v, str) else v

    schema = SCHEMAS[table]
    return spark.createDataFrame([tuple(value(f, v) for f, v in zip(schema, row)) for row in rows], schema)
