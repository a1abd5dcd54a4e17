"""Records of CSV files whose quoted cells hold line breaks, read by many tasks a file.

A line feed ends a record when the quotes before it in the file are even in number. Every split counts the quotes of its
lines; sums over the splits before tell each split whether it starts inside a quoted cell. So every task finds the true
ends of records in its own lines. What a split holds of records that start or end in another one is put together from its
pieces, of which a split has two at most.

As RFC 4180 has it, quotes only enclose cells, and a quote inside is doubled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package


def starts(quotes: dict[tuple[str, int], int]) -> dict[tuple[str, int], int]:
    """Of the splits (file, offset) that start inside a record: the offset of the split in which it starts."""
    found, file, origin, total = {}, None, None, 0
    for (name, offset), n in sorted(quotes.items()):
        if name != file:
            file, origin, total = name, None, 0
        if total % 2:
            found[name, offset] = origin
        if n:  # an open record at the end of this split starts here, unless the split has no quote
            origin = offset
        total += n
    return found


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(value) for every record of the files at `path` but their first lines, which are headers without line breaks."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "offset").agg(F.sum(quotes).alias("n")).collect()  # a row per split
    inside = spark.sparkContext.broadcast(starts({(r["file"], r["offset"]): r["n"] for r in counted}))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, origin, open_, first = None, [], None, False, False
        rows: list[tuple] = []

        def close() -> None:
            """A record, or a piece of one, ends here."""
            nonlocal held, origin
            if held:
                rows.append((at[0], origin, at[1], "\n".join(held)))
            held, origin = [], None

        for batch in batches:
            for value, *split in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if tuple(split) != at:
                    if at is not None and held:
                        origin = at[1] if origin is None else origin
                        close()
                    at = tuple(split)
                    origin = inside.value.get(at)
                    open_, first = origin is not None, at[1] == 0
                if first:
                    first = False
                    continue
                held.append(value)
                open_ ^= value.count('"') % 2 == 1
                if not open_:
                    close()
            if rows:
                yield made(rows)
                rows.clear()
        if at is not None and held:
            origin = at[1] if origin is None else origin
            close()
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "origin", "offset", "value"])

    found = lines.mapInArrow(of_batches, "file string, origin long, offset long, value string")
    whole = found.filter(F.col("origin").isNull()).select("value")
    pieces = found.filter(F.col("origin").isNotNull()).groupBy("file", "origin").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("p"))
    records = whole.union(pieces.select(F.array_join(F.transform("p", lambda p: p["value"]), "\n")))
    return records.select(F.rtrim(F.col("value"), F.lit("\r")).alias("value")).filter("value <> ''")
