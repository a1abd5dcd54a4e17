"""Trie of conversation prefixes, by truncation peeling.

A node is a distinct sequence of turns with which at least one conversation starts. The deepest level is built
first: a level's nodes are the conversations that end there, grouped with the surviving nodes of the level
below after their last turn is stripped. One aggregation per level both finds the nodes and sums up what the
level below has found out (members, children, leaves, tokens saved); no conversation is expanded into all its
prefixes. Levels are written to the shared folder one after the other, so a lost executor costs part of one
level, and no level's plan holds the levels below it. A long branch that meets no other is stripped in one go.

A turn enters as 24 bytes: the MD5 digest of role and text, and the text's number of words. A path is the
concatenation for the turns from the root, so stripping a turn is taking a shorter prefix and the words of the
last turn are read off its end. All sums combine on the map side: copies of one conversation, or a turn with
which most start, are one row per map task. The list of conversations that end at a node is never collected:
ids are sorted by ranges, each run is written as pieces of text, and the pieces are digested as a stream.

Defined cases: turns go by `turn`, NULL first; ties by digest of role and text, then words. A NULL role or text
is empty. Repeated rows are turns of their own. Rows without conv_id belong to no conversation and are left
out. A conversation whose rebuilt form has no turn ends at the root. An empty table gives an empty result, without
a root. Other columns do not matter, whatever their names. Long texts only meet a digest. A conversation is one
row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import shared_dir, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

WORD = "[^\\x20\\x09-\\x0D]+"
TURN_BYTES = 24
LEVELS = 8  # up to this depth levels go one by one
PIECE_IDS = 1 << 16  # ids in one piece of a node's list


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order as (digest with words)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.unhex(F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 16, "0"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), F.concat(digest, words).alias("key")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["key"]).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, depth): the first turns come from the conversation c - c%20, as many as crc32(c)%4 says."""
    conv = F.col("conv_id")
    borrowed = F.crc32(conv.cast("string")) % 4
    heads = turns.filter(conv % 20 == 0).select(conv.alias("head_id"), F.slice("turns", 1, 3).alias("head"))
    own = turns.withColumn("h", borrowed.cast("int"))
    joined = own.join(heads, conv - conv % 20 == F.col("head_id"), "left")
    head = F.coalesce(F.slice(F.col("head"), F.lit(1), F.col("h")), F.array().cast("array<binary>"))
    path = F.concat(head, F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return joined.select("conv_id", path.alias("path")).select(
        "conv_id", F.array_join(F.transform("path", lambda t: F.hex(t)), "").alias("path"), F.size("path").alias("depth")
    ).select("conv_id", F.unhex("path").alias("path"), "depth")


def _words(path: Column, turn: Column | int) -> Column:
    """Words of a turn (from 1) of a path."""
    return F.conv(F.hex(F.substring(path, (turn - 1) * TURN_BYTES + 17, 8)), 16, 10).cast("long")


def _prefix(path: str, depth: int) -> Column:
    return F.substring(F.col(path), F.lit(1), F.lit(depth * TURN_BYTES))


def _merged(parts: DataFrame) -> DataFrame:
    """What is known of each node so far, from parts of the same form; the node itself is not yet in `below`."""
    return parts.groupBy("path", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "below")]
    )


def _finished(nodes: DataFrame) -> DataFrame:
    """Nodes all of whose parts are merged."""
    depth = F.col("depth")
    own = F.when((F.col("n_convs") > 1) & (depth > 0), (F.col("n_convs") - 1) * _words(F.col("path"), depth)).otherwise(F.lit(0))
    return nodes.select(
        "path", "depth", "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), (F.col("below") + own).alias("saved_tokens")
    )


def _stripped(nodes: DataFrame, depth: int) -> DataFrame:
    """Finished nodes as parts of their ancestors at `depth`, which have no other node between."""
    return nodes.select(
        _prefix("path", depth).alias("path"), F.lit(depth).alias("depth"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
        "n_leaves", F.col("saved_tokens").alias("below"),
    )


def _branches(lone: DataFrame, bottom: int) -> DataFrame:
    """All nodes from merged ones up to depth `bottom` + 1, where nothing joins them on the way."""
    n, depth, whole = F.col("n_convs"), F.col("depth"), F.col("whole")  # inside a lambda, `path` would be the new column
    turns = F.transform(F.sequence(F.col("at"), depth), lambda i: _words(whole, i))
    saved = F.when(n > 1, (n - 1) * F.aggregate(turns, F.lit(0).cast("long"), lambda a, w: a + w)).otherwise(F.lit(0))
    each = lone.withColumnRenamed("path", "whole").select("*", F.explode(F.sequence(F.lit(bottom + 1), depth)).alias("at"))
    top = F.col("at") == depth
    return each.select(
        F.expr(f"substring(whole, 1, at * {TURN_BYTES})").alias("path"), F.col("at").alias("depth"), "conv_id", "n_convs",
        F.when(top, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), (F.col("below") + saved).alias("saved_tokens"),
    )


def peel(convs: DataFrame) -> DataFrame:
    """All nodes of (conv_id, path, depth), from the deepest to the root; `convs` is a stored table.

    Depths go in bands between powers of two. At the lower end of a band, a branch that shares its prefix with no
    other is stripped down to there at once; the others go level by level. So the rounds are as many as the
    deepest level that two different conversations share in a band, not as the longest conversation has turns.
    """
    spark = convs.sparkSession
    folder, number = f"{shared_dir(spark)}/{uuid.uuid4().hex}", 0
    long = lambda x: F.lit(x).cast("long")
    ended = convs.select("path", "depth", "conv_id", long(1).alias("n_convs"), long(0).alias("n_children"), long(0).alias("n_leaves"), long(0).alias("below"))
    schema = _finished(_merged(ended)).schema

    def kept(nodes: DataFrame) -> DataFrame:
        """Nodes of the result, written and read again."""
        nonlocal number
        number += 1
        nodes.write.parquet(f"{folder}/{number}")
        return spark.read.schema(schema).parquet(f"{folder}/{number}")

    def levels(parts: DataFrame, highest: int, lowest: int) -> DataFrame | None:
        """Finish all nodes from `highest` to `lowest`; gives those of the last level."""
        last = None
        for depth in range(highest, lowest - 1, -1):
            here = parts.filter(F.col("depth") == depth)
            last = kept(_finished(_merged(here if last is None else here.unionByName(_stripped(last, depth)))))
        return last

    deepest = convs.agg(F.max("depth")).first()[0]  # one number
    if deepest is None:
        return _finished(_merged(ended))
    pending, top = None, deepest
    while top > LEVELS:
        bottom = max(LEVELS, 1 << (top - 1).bit_length() - 1)
        parts = ended.filter((F.col("depth") > bottom) & (F.col("depth") <= top))
        parts = stage(_merged(parts if pending is None else parts.unionByName(pending)))
        parts_of = parts.withColumn("under", F.md5(_prefix("path", bottom)))
        alone = parts_of.groupBy("under").agg(F.count("*").alias("n")).filter("n = 1").select("under")
        lone = kept(_branches(parts_of.join(alone, "under", "left_semi"), bottom))
        rest = stage(parts_of.join(alone, "under", "left_anti").select(*parts.columns))
        pending = _stripped(lone.filter(F.col("depth") == bottom + 1), bottom)
        highest = rest.agg(F.max("depth")).first()[0]  # one number
        if highest is not None:
            pending = pending.unionByName(_stripped(levels(rest, highest, bottom + 1), bottom))
        top = bottom
    parts = ended.filter(F.col("depth") <= top)
    levels(parts if pending is None else parts.unionByName(pending), top, 0)
    return spark.read.schema(schema).parquet(*[f"{folder}/{i + 1}" for i in range(number)])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (key, conv_id) as (key, first id, "id,id,..."), a bounded number of ids in each batch."""
    rows, held = [], 0  # a row: key, first id, ids as text

    def out():
        columns = [pa.array(c, kind) for c, kind in zip(zip(*[(k, i, ",".join(ids)) for k, i, ids in rows]), (pa.binary(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["key", "first_id", "piece"])

    for batch in batches:
        for key, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held == PIECE_IDS:
                yield out()
                rows, held = [], 0
            if not rows or rows[-1][0] != key:
                rows.append((key, i, []))
            rows[-1][2].append(str(i))
            held += 1
    if rows:
        yield out()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, sha256) of the pieces of each key, joined by commas; pieces come sorted and are not kept."""
    key, state, keys, found = None, None, [], []
    for batch in batches:
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(2)):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            state.update(piece.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], ["key", "ends_sha256"])
        keys, found = [], []
    if state is not None:  # the last key may go on through many batches
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): ids in ascending order as decimal text, joined by commas.

    Ranges of (key, conv_id) split a key with most ids over tasks; what then meets in one task is finished text.
    """
    runs = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    pieces = runs.mapInArrow(_pieces, "key binary, first_id long, piece string")
    return pieces.repartition("key").sortWithinPartitions("key", "first_id").mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations, with what holds for its subtree; see the columns below."""
    key = lambda path: F.unhex(F.md5(path))
    convs = stage(rebuilt(turns_of(conversations)))
    nodes = peel(convs)
    ends = end_digests(convs.select(key(F.col("path")).alias("key"), "conv_id"))
    parent_path = F.expr(f"substring(path, 1, octet_length(path) - {TURN_BYTES})")
    parents = nodes.select(key(F.col("path")).alias("up"), F.col("conv_id").alias("parent_conv_id"))
    rows = nodes.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        key(F.col("path")).alias("key"), F.when(F.col("depth") > 0, key(parent_path)).alias("up"),
    )
    return rows.join(ends, "key", "left").join(parents, "up", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text"))


OP11_SQL = """
WITH ordered AS (
    SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS at
    FROM conversations WHERE conv_id IS NOT NULL
), checksum AS (  -- crc32 of the decimal digits, bit by bit
    SELECT conv,
           xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda a, x: list_reduce(list_prepend(xor(a, x), list_transform(range(8), lambda y: 0::BIGINT)),
                                     lambda b, y: xor(b >> 1, 3988292384 * (b & 1))))) % 4 AS h
    FROM (SELECT DISTINCT conv FROM ordered)
), turns AS (
    SELECT c.conv, 0 AS part, o.at, o.role, o.text FROM checksum c JOIN ordered o ON o.conv = c.conv - c.conv % 20 AND o.at <= c.h
    UNION ALL
    SELECT c.conv, 1 AS part, o.at, o.role, o.text FROM checksum c JOIN ordered o ON o.conv = c.conv AND o.at > c.h
), rebuilt AS (
    SELECT c.conv, coalesce(list({'role': t.role, 'text': t.text} ORDER BY t.part, t.at) FILTER (WHERE t.at IS NOT NULL), []) AS path
    FROM checksum c LEFT JOIN turns t USING (conv) GROUP BY c.conv
), prefixes AS (
    SELECT conv, path[1:d] AS node, d, len(path) = d AS ends
    FROM (SELECT conv, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT node, d, min(conv) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (WHERE ends), '')) AS ends_sha256,
           CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
    FROM prefixes GROUP BY node, d
), children AS (
    SELECT node[1:d - 1] AS parent, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), subtrees AS (
    SELECT node[1:a] AS top, a AS d, sum((n_convs - 1) * words) AS saved, sum((n IS NULL)::INT) AS leaves
    FROM (SELECT x.node, x.n_convs, x.words, c.n, unnest(range(0, x.d + 1)) AS a
          FROM nodes x LEFT JOIN children c ON c.parent = x.node AND c.d = x.d)
    GROUP BY ALL
)
SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes x
JOIN subtrees s ON s.top = x.node AND s.d = x.d
LEFT JOIN children c ON c.parent = x.node AND c.d = x.d
LEFT JOIN nodes p ON x.d > 0 AND p.d = x.d - 1 AND p.node = x.node[1:x.d - 1]
"""
