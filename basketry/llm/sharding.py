"""Shards of equal bytes by a k-d tree over document metadata.

The unit is a group of equal texts, which stays in one shard. Units are points whose coordinates are the
metadata (numbers on a common scale, names by hash). The root holds all shards; a node is split along its
widest dimension at the weighted median of bytes, until every leaf holds one shard, that is its target
bytes. Medians are found exactly enough by refined histograms: a pass sums bytes in at most SLICES ranges
per node, so the driver sees a bounded number of rows and no task sees a whole node.

Heavy groups would make near equal sizes impossible if a median fell into them. Groups beyond a small share
of a shard (their number is bounded by that share) are placed first, the largest to the emptiest shard, and
the tree gives each leaf what is then missing. Only a group larger than a shard is cut, by the rank of its rows.

Defined cases: a NULL text weighs 1 like an empty one and is grouped with it. NULL metadata or ids are a
value of their own. Repeated rows each get a slot. An empty table gives an empty result. Other input columns
do not matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from ..operators.ranking import global_rank
from ..sources.staging import stage

SHARDS = 8
DIMENSIONS = ("n_chars", "lang", "source")
SLICES = 1024
HEAVY_SHARE = 256  # a group beyond 1 / HEAVY_SHARE of a shard is placed by itself: at most SHARDS * HEAVY_SHARE groups
EXACT_SHARE = 4096  # a median is settled when its range holds less than 1 / EXACT_SHARE of a shard
_COORDINATE_BITS = 31
_TIE_BITS = 32


@dataclass
class _Node:
    first: int  # shards first .. last - 1
    last: int
    dimension: str = ""
    at: int = 0  # keys up to this go left
    left: _Node | None = None
    right: _Node | None = None


@dataclass
class _Search:
    low: int
    high: int
    wanted: float  # bytes still to go left of the median within the range


def _key(dimension: str) -> Column:
    """Position along a dimension as a number without sign; equal coordinates are ordered by the unit's hash."""
    return F.shiftleft(F.col(dimension), _TIE_BITS).bitwiseOR(F.shiftrightunsigned("_unit", 64 - _TIE_BITS))


def _leaf(node: _Node, value) -> Column:
    """Walk the tree built so far; `value` makes a column of the node reached."""
    if node.left is None:
        return value(node)
    return F.when(_key(node.dimension) <= node.at, _leaf(node.left, value)).otherwise(_leaf(node.right, value))


def _coordinates(units: DataFrame, dimensions: list[str]) -> DataFrame:
    """The dimensions as numbers of 31 bits: logarithmic scale from least to most, or a hash of a name."""
    top = (1 << _COORDINATE_BITS) - 1
    numeric = [c for c in dimensions if isinstance(units.schema[c].dataType, NumericType)]
    scaled = {c: F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) for c in numeric}
    ends = units.agg(F.count("*"), *[f(scaled[c]).alias(f"{n}_{c}") for c in numeric for n, f in (("min", F.min), ("max", F.max))]).first()
    made = {}
    for c in dimensions:
        if c in numeric:
            least, most = ends[f"min_{c}"] or 0.0, ends[f"max_{c}"] or 0.0
            made[c] = F.coalesce(((scaled[c] - least) / ((most - least) or 1.0) * top).cast("long"), F.lit(0).cast("long"))
        else:
            made[c] = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit(""))), 64 - _COORDINATE_BITS)
    return units.select("_unit", "_weight", *[made[c].alias(f"_d{i}") for i, c in enumerate(dimensions)])


def _medians(units: DataFrame, open_nodes: list[_Node], root: _Node, keys: dict[int, str], targets: dict[int, float], enough: float) -> dict[int, int]:
    """For every open node (by first shard) the largest key that goes left."""
    searches = {n.first: _Search(0, (1 << (_COORDINATE_BITS + _TIE_BITS)) - 1, targets[n.first]) for n in open_nodes}
    found: dict[int, int] = {}
    node_of = _leaf(root, lambda n: F.lit(n.first))
    key = _leaf(root, lambda n: _key(keys[n.first]) if n.first in keys else F.lit(-1).cast("long"))
    placed = units.select("_weight", node_of.alias("node"), key.alias("key"))
    while searches:
        width = {n: (s.high - s.low) // SLICES + 1 for n, s in searches.items()}
        cut = F.lit(None).cast("long")
        for n, s in searches.items():
            cut = F.when((F.col("node") == n) & F.col("key").between(s.low, s.high), F.call_function("div", F.col("key") - s.low, F.lit(width[n]).cast("long"))).otherwise(cut)
        sums = placed.select("node", "_weight", cut.alias("slice")).filter("slice IS NOT NULL").groupBy("node", "slice").agg(F.sum("_weight").alias("bytes"))
        rows = sorted((r["node"], r["slice"], r["bytes"]) for r in sums.collect())  # at most SLICES per open node
        for n, s in list(searches.items()):
            mine = [(k, b) for m, k, b in rows if m == n]
            before, number, here = 0, 0, 0
            for number, here in mine:
                if before + here >= s.wanted:
                    break
                before += here
            low = s.low + number * width[n]
            high = min(s.high, low + width[n] - 1)
            if width[n] == 1 or here <= enough or not mine:
                found[n] = high if s.wanted - before > here / 2 else low - 1
                del searches[n]
            else:
                searches[n] = _Search(low, high, s.wanted - before)
    return found


def build_tree(units: DataFrame, dimensions: int, shards: int, room: list[float], enough: float) -> _Node:
    """The k-d tree over `units` (`_unit`, `_weight`, `_d0`, ...); shard i should get `room[i]` bytes."""
    root = _Node(0, shards)
    level = [root] if shards > 1 else []
    while level:
        node_of = _leaf(root, lambda n: F.lit(n.first))
        names = [f"_d{i}" for i in range(dimensions)]
        stats = units.select("*", node_of.alias("node")).groupBy("node").agg(
            F.sum("_weight").alias("bytes"), *[(F.max(c) - F.min(c)).alias(c) for c in names]
        )
        by_node = {r["node"]: r for r in stats.collect()}  # one row per node
        keys, targets = {}, {}
        for n in level:
            row, middle = by_node.get(n.first), (n.first + n.last) // 2
            keys[n.first] = max(names, key=lambda c: row[c]) if row else names[0]
            left, whole = sum(room[n.first : middle]), sum(room[n.first : n.last])
            targets[n.first] = (row["bytes"] if row else 0) * (left / whole if whole else 0.5)
        found = _medians(units, level, root, keys, targets, enough)
        for n in level:
            middle = (n.first + n.last) // 2
            n.dimension, n.at = keys[n.first], found[n.first]
            n.left, n.right = _Node(n.first, middle), _Node(middle, n.last)
        level = [c for n in level for c in (n.left, n.right) if c.last - c.first > 1]
    return root


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: tuple[str, ...] = DIMENSIONS, shards: int = SHARDS
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, and slot, the place within the shard in order of doc_id."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = {c: f"_m{i}" for i, c in enumerate(dimensions)}
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_text"),
        *[F.col(c).alias(n) for c, n in names.items()],
    )
    rows = stage(rows)

    def units_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_unit").agg(F.sum("size").alias("_weight"), F.count("*").alias("_rows"), *[F.min(n).alias(n) for n in names.values()])

    total = rows.agg(F.sum("size")).first()[0] or 0
    target = total / shards
    whole = rows.withColumn("_unit", F.col("_text"))
    larger = units_of(whole).filter(F.col("_weight") > target).collect()  # fewer than `shards`
    if larger:
        # Cut by rank, not by a value: whatever the ids, missing or repeated, the pieces are even.
        inside = F.col("_text").isin([r["_unit"] for r in larger])
        ranked, before, part = global_rank(rows.filter(inside), ["_text", "doc_id"], "_at"), 0, F.lit(0).cast("long")
        for r in sorted(larger, key=lambda r: r["_unit"]):
            pieces = -(-r["_weight"] * 4 // max(1, int(target)))  # quarters of a shard
            piece = F.call_function("div", (F.col("_at") - 1 - before) * int(pieces), F.lit(r["_rows"]).cast("long")) + 1
            part, before = F.when(F.col("_text") == r["_unit"], piece).otherwise(part), before + r["_rows"]
        cut = ranked.withColumn("_unit", F.xxhash64("_text", part)).drop("_at")
        rows = stage(cut.unionByName(rows.filter(~inside).withColumn("_unit", F.col("_text"))))
    else:
        rows = whole
    units = stage(_coordinates(units_of(rows), list(names.values())))

    is_heavy = F.col("_weight") > target / HEAVY_SHARE
    load, placed = [0] * shards, []
    for r in units.filter(is_heavy).orderBy(F.desc("_weight"), "_unit").select("_unit", "_weight").collect():  # at most shards * HEAVY_SHARE
        emptiest = min(range(shards), key=lambda i: (load[i], i))
        load[emptiest] += r["_weight"]
        placed.append((r["_unit"], emptiest))
    light = units.filter(~is_heavy)
    tree = build_tree(light, len(dimensions), shards, [max(0.0, target - x) for x in load], target / EXACT_SHARE)
    heavy = spark.createDataFrame(placed, "_unit long, _fixed int")
    located = units.join(F.broadcast(heavy), "_unit", "left").select(  # bounded, see above
        "_unit", F.coalesce("_fixed", _leaf(tree, lambda n: F.lit(n.first))).alias("shard")
    )
    sharded = stage(rows.join(located, "_unit").select("doc_id", "size", "text_crc32", "shard"))
    counts = {r["shard"]: r["count"] for r in sharded.groupBy("shard").count().collect()}
    before = F.lit(0).cast("long")
    for shard in range(1, shards):
        before = F.when(F.col("shard") == shard, F.lit(sum(counts.get(i, 0) for i in range(shard))).cast("long")).otherwise(before)
    ranked = global_rank(sharded, ["shard", "doc_id"], "_rank")
    return ranked.select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - 1 - before).alias("slot"))


def op3_sharding(spark: SparkSession, d: str) -> DataFrame:
    found = shard_documents(spark.read.parquet(f"{d}/documents.parquet"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
