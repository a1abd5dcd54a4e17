"""Ranks over a whole table without pulling it into one task.

A window without PARTITION BY sorts everything in a single task. `global_rank` sorts by ranges instead and
adds up partition sizes. `score_quintiles` does not need ranks at all: five bins have four edges, so it
finds the four rows at the edges and compares every row with them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType

from ..sources.staging import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the low 33 bits

BINS = 5
SLICES = 1024  # histogram slices per search and pass
FETCH_LIMIT = 10_000  # rows per search that may be sorted on the driver


def global_rank(df: DataFrame, order_by: list[str], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in ascending order of `order_by`; equal rows keep their input order.

    One range shuffle. The input position is the last sort key, so a value shared by most rows is still
    spread over many ranges. The sorted rows are staged, because range limits come from a sample and
    would differ from one job to the next. Where `order_by` has ties, pass a scan or a stored table: its
    input order is the same when a lost task runs again.
    """
    placed = (
        df.withColumn("_position", F.monotonically_increasing_id())
        .repartitionByRange(*order_by, "_position")
        .sortWithinPartitions(*order_by, "_position")
        .withColumn("_position", F.monotonically_increasing_id())
    )
    placed = stage(placed, "zstd")
    partition = F.shiftright("_position", _ROW_BITS)
    sizes = placed.groupBy(partition.alias("p")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, {}
    for p, n in sorted((row.p, row.n) for row in sizes):  # one number per shuffle partition
        offsets[p] = before
        before += n
    spark = df.sparkSession
    starts = spark.createDataFrame(list(offsets.items()) or [(0, 0)], "_partition long, _before long")
    in_partition = F.col("_position").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(starts), "_partition")  # one row per shuffle partition
        .select(*df.columns, (F.col("_before") + in_partition + 1).alias(name))
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def quintile_of_rank(rank: Column, n: Column) -> Column:
    """Bin 1..5 of a rank among n rows, cutting at evenly spaced quantiles of the ranks.

    The edges lie at 1 + j(n-1)/5, and a rank on an edge belongs to the lower bin. This is not ntile(5),
    which cuts by row counts.
    """
    rank, n = rank.cast("long"), n.cast("long")
    return F.greatest(F.lit(1).cast("long"), _div((rank - 1) * BINS + n - 2, n - 1)).cast("int")


def _as_long(df: DataFrame, name: str) -> Column:
    """An integer, date or decimal column as a long that sorts the same way."""
    kind: DataType = df.schema[name].dataType
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(name).cast("long")
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("long")
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        return (F.col(name) * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("long")
    raise TypeError(f"{name}: cannot rank {kind.simpleString()}")


@dataclass(frozen=True)
class _Range:
    """Rows that may hold a wanted one: a range of values or, for one value, a range of ids."""

    metric: str
    low: int
    high: int
    value: int | None = None

    def holds(self) -> Column:
        if self.value is None:
            return F.col(self.metric).between(self.low, self.high)
        return (F.col(self.metric) == self.value) & F.col("_id").between(self.low, self.high)

    def width(self, slices: int) -> int:
        return (self.high - self.low) // slices + 1

    def slice_of(self, slices: int) -> Column:
        key = F.col(self.metric if self.value is None else "_id")
        return _div(key - self.low, F.lit(self.width(slices)).cast("long"))


@dataclass(frozen=True)
class _Search:
    where: _Range
    nth: int  # 0-based among the rows in the range
    rows: int  # rows in the range


def _tag(keys: DataFrame, ranges: list[_Range], payload) -> DataFrame:
    """One output row per row and range it lies in: (range number, payload of that range)."""
    hits = [F.when(r.holds(), F.struct(F.lit(i).alias("range"), *payload(r))) for i, r in enumerate(ranges)]
    return keys.select(F.explode(F.array_compact(F.array(*hits))).alias("hit")).select("hit.*")


def _narrow(keys: DataFrame, searches: list[_Search], ids: tuple[int, int], slices: int) -> list[_Search]:
    """Cut every search range into slices, count them in one job and keep the slice with the wanted row."""
    ranges = list(dict.fromkeys(s.where for s in searches))
    counted = _tag(keys, ranges, lambda r: [r.slice_of(slices).alias("slice")]).groupBy("range", "slice").count()
    counts: dict[_Range, list[tuple[int, int]]] = {r: [] for r in ranges}
    for row in counted.collect():  # at most `slices` rows per range
        counts[ranges[row["range"]]].append((row["slice"], row["count"]))
    narrowed = []
    for search in searches:
        where, nth = search.where, search.nth
        for number, rows in sorted(counts[where]):
            if nth < rows:
                break
            nth -= rows
        low = where.low + number * where.width(slices)
        high = min(where.high, low + where.width(slices) - 1)
        if where.value is None and low == high:
            where = _Range(where.metric, ids[0], ids[1], value=low)
        else:
            where = replace(where, low=low, high=high)
        narrowed.append(_Search(where, nth, rows))
    return narrowed


def _fetch(keys: DataFrame, searches: list[_Search]) -> list[tuple[int, int]]:
    """The wanted (value, id) pairs, from ranges already known to hold few rows; one row per pair comes."""
    ranges = list(dict.fromkeys(s.where for s in searches))
    rows: dict[_Range, list[tuple[int, int]]] = {r: [] for r in ranges}
    tagged = _tag(keys, ranges, lambda r: [F.col(r.metric).alias("value"), F.col("_id")])
    for row in tagged.groupBy("range", "value", "_id").count().collect():
        if row["count"] > 1:
            raise ValueError(f"cannot rank: id {row['_id']} occurs {row['count']} times")
        rows[ranges[row["range"]]].append((row["value"], row["_id"]))
    return [sorted(rows[s.where])[s.nth] for s in searches]


def bin_edges(
    df: DataFrame, id_col: str, columns: list[str], slices: int = SLICES, fetch_limit: int = FETCH_LIMIT
) -> dict[str, list[tuple[int, int]]]:
    """Per column, the last (value, id) of bins 1 to 4 in the order of (value, id).

    Exact selection by repeated histograms. Every pass reads the table once for all columns together and
    brings at most `slices` counts per open search to the driver. Passes grow with the logarithm of the
    value range, not with the rows, and a value shared by most rows is cut further by id.
    """
    keys = df.select(_as_long(df, id_col).alias("_id"), *[_as_long(df, c).alias(c) for c in columns])
    names = ["_id", *columns]
    stats = keys.agg(
        F.count("*").alias("n"),
        *[F.min(c).alias(f"min_{c}") for c in names],
        *[F.max(c).alias(f"max_{c}") for c in names],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in names],
    ).first()
    if stats.n < 2:
        raise ValueError(f"cannot cut {stats.n} row(s) into {BINS} bins: bin edges must be unique")
    missing = [c for c in names if stats[f"nulls_{c}"]]
    if missing:
        raise ValueError(f"cannot rank NULL: {', '.join(missing)}")
    ids = (stats["min__id"], stats["max__id"])
    searches = [
        _Search(_Range(c, stats[f"min_{c}"], stats[f"max_{c}"]), j * (stats.n - 1) // BINS, stats.n)
        for c in columns
        for j in range(1, BINS)
    ]
    while True:
        wide = [s for s in searches if s.rows > fetch_limit and (s.where.value is None or s.where.low < s.where.high)]
        if not wide:
            break
        narrower = dict(zip(wide, _narrow(keys, wide, ids, slices)))
        searches = [narrower.get(s, s) for s in searches]
    found = _fetch(keys, searches)
    per_column = BINS - 1
    return {c: found[i * per_column : (i + 1) * per_column] for i, c in enumerate(columns)}


def score_quintiles(
    df: DataFrame, id_col: str, scores: dict[str, tuple[str, bool]], slices: int = SLICES, fetch_limit: int = FETCH_LIMIT
) -> DataFrame:
    """Add a 1..5 score per entry of `scores`: {score column: (metric column, higher is better)}.

    Same bins as ranking all rows by (metric, id) and applying `quintile_of_rank`, but without sorting or
    shuffling the table: the rows are compared with four edges per metric. `df` is read several times, so
    it should be a stored table. `id_col` must be unique; a repeated id at an edge stops the job.
    """
    metrics = list(dict.fromkeys(metric for metric, _ in scores.values()))
    edges = bin_edges(df, id_col, metrics, slices, fetch_limit)
    row_id = _as_long(df, id_col)
    added = {}
    for score, (metric, higher_is_better) in scores.items():
        value = _as_long(df, metric)
        passed = F.lit(1)
        for edge_value, edge_id in edges[metric]:
            passed = passed + ((value > edge_value) | ((value == edge_value) & (row_id > edge_id))).cast("int")
        added[score] = passed if higher_is_better else F.lit(BINS + 1) - passed
    return df.withColumns(added)
