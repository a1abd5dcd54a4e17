"""Benchmark passages in documents: exact containment of item-sized windows, found by rare shingles.

An item's windows are its runs of `window` words (a shorter item is one window). Every window is a set of
three-word shingles (or, if shorter, is its own shingle). The documents are counted once for all benchmark
shingles, which orders them by rarity; containment must be complete, so the necessary prefix of a window is
its one rarest shingle. A document position that matches a prefix shingle gives, through the shingle's offset,
the only place where the window can stand; places that leave the document are dropped (length and
positional bound) and the rest is compared word by word.

The benchmark is taken in blocks of bounded size, each sent to all tasks; documents are never shuffled, so
neither a hot word nor a group of copies meets in one task. The state of a row (covered spans, items) goes
through the blocks with the row.

Defined cases: NULL or empty texts have no words. Items without words or without id are left out; rows that
repeat an item_id are one item with all their windows. Repeated documents each get a result. Empty tables:
no documents give no rows, no items leave every document clean. Other columns do not matter, whatever their
names; `drop_contaminated` returns them as they were.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 8 << 20  # of benchmark text in one index; more is taken in several blocks
_WORDS_AT_ONCE = 1 << 20
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
# A-Z in lower case; other ASCII that is no digit or letter becomes a blank.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _keys(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of `size` words, and whether all its words are known (id above 0)."""
    n = max(0, len(ids) - size + 1)
    key, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(size):
        part = ids[i : i + n]
        key += part.astype(np.uint64) * _MIX[i]
        known &= part > 0
    return key, known


@dataclass
class Index:
    """Windows of one block of items. Word ids start at 1; 0 is any other word."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    windows: list[np.ndarray] = field(default_factory=list)
    items: list[list[str]] = field(default_factory=list)  # per window
    shingles: dict[int, np.ndarray] = field(default_factory=dict)  # size -> sorted distinct keys
    lengths: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # words per window
    anchors: dict[int, tuple] = field(default_factory=dict)  # size -> keys, first entry of each, entries (window, offset)

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))


def build_index(items: list[tuple[str, str | None]], window: int = WINDOW) -> Index:
    index, by_window = Index(), {}
    for item_id, text in items:
        words = words_of(text)
        ids = [index.vocabulary.setdefault(w, len(index.vocabulary) + 1) for w in words]
        for at in range(max(1, len(ids) - window + 1) if ids else 0):
            by_window.setdefault(tuple(ids[at : at + window]), set()).add(item_id)
    for ids, owners in by_window.items():
        index.windows.append(np.array(ids, np.int64))
        index.items.append(sorted(owners))
    keys: dict[int, list[np.ndarray]] = {}
    for ids in index.windows:
        size = min(SHINGLE, len(ids))
        keys.setdefault(size, []).append(_keys(ids, size)[0])
    index.lengths = np.array([len(w) for w in index.windows], np.int64)
    index.shingles = {size: np.unique(np.concatenate(parts)) for size, parts in keys.items()}
    return index


def _look_up(sorted_keys: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ids, places in sorted_keys) of the shingles that are among the keys."""
    key, known = _keys(ids, size)
    at = np.flatnonzero(known)
    place = np.searchsorted(sorted_keys, key[at])
    place[place == len(sorted_keys)] = 0
    hit = sorted_keys[place] == key[at]
    return at[hit], place[hit]


def choose_anchors(index: Index, counts: dict[int, np.ndarray]) -> None:
    """Give every window its rarest shingle, the first one on ties."""
    chosen: dict[int, list[tuple[int, int, int]]] = {}
    for number, ids in enumerate(index.windows):
        size = min(SHINGLE, len(ids))
        key = _keys(ids, size)[0]
        offset = int(np.argmin(counts[size][np.searchsorted(index.shingles[size], key)]))
        chosen.setdefault(size, []).append((int(key[offset]), number, offset))
    for size, entries in chosen.items():
        entries.sort()
        keys, first = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
        index.anchors[size] = (keys, np.append(first, len(entries)), np.array([e[1:] for e in entries], np.int64))


def _flat(texts: Iterator[str | None], index: Index) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Word ids of consecutive texts, a 0 after each, with the texts' word counts; about a million words at a time."""
    parts, sizes, total = [], [], 0
    for text in texts:
        ids = index.ids(words_of(text))
        parts += [ids, np.zeros(1, np.int64)]
        sizes.append(len(ids))
        total += len(ids) + 1
        if total >= _WORDS_AT_ONCE:
            yield np.concatenate(parts), sizes
            parts, sizes, total = [], [], 0
    if sizes:
        yield np.concatenate(parts), sizes


def find_windows(ids: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(start, window number) of every occurrence in `ids`; unknown words and text ends are 0."""
    starts, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size, (keys, first, entries) in index.anchors.items():
        at, place = _look_up(keys, ids, size)
        shared = first[place + 1] - first[place]
        row = np.repeat(np.arange(len(at)), shared)
        entry = entries[first[place][row] + np.arange(len(row)) - np.repeat(np.cumsum(shared) - shared, shared)]
        start, number = at[row] - entry[:, 1], entry[:, 0]
        lengths = index.lengths[number]
        inside = (start >= 0) & (start + lengths <= len(ids))
        start, number, lengths = start[inside], number[inside], lengths[inside]
        same = np.fromiter(
            (np.array_equal(ids[s : s + n], index.windows[w]) for s, n, w in zip(start, lengths, number)), bool, len(start)
        )
        starts.append(start[same])
        numbers.append(number[same])
    return np.concatenate(starts), np.concatenate(numbers)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) rows as disjoint rows in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], axis=1)


def _count(rows: DataFrame, shared) -> DataFrame:
    """(size, place, n): occurrences of the benchmark shingles in column `_text` of all rows."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(shared.value)
        totals = {size: np.zeros(len(keys), np.int64) for size, keys in index.shingles.items()}
        for batch in batches:
            for ids, _ in _flat((t.as_py() for t in batch.column(0)), index):
                for size, keys in index.shingles.items():
                    totals[size] += np.bincount(_look_up(keys, ids, size)[1], minlength=len(keys))
        for size, total in totals.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), size)), pa.array(place), pa.array(total[place])], ["size", "place", "n"])

    return rows.select("_text").mapInArrow(of_batches, "size long, place long, n long")


_STATE = [
    StructField("_n_words", LongType()),
    StructField("_n_hit", LongType()),
    StructField("_spans", BinaryType()),
    StructField("_items", ArrayType(StringType())),
]


def _scan(rows: DataFrame, shared) -> DataFrame:
    """Add what one block finds to the state columns of `rows` (columns `_text` and `_carried`, then the state)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(shared.value)
        for batch in batches:
            texts, olds, old_items = batch.column(0), batch.column(4), batch.column(5)
            n_words, n_hit, spans, items, row = [], [], [], [], 0
            for ids, sizes in _flat((t.as_py() for t in texts), index):
                start, number = find_windows(ids, index)
                order = np.argsort(start, kind="stable")
                start, number = start[order], number[order]
                begin = 0
                for size in sizes:
                    lo, hi = np.searchsorted(start, [begin, begin + size + 1])
                    found, names = number[lo:hi], set(old_items[row].as_py() or ())
                    for w in np.unique(found):
                        names.update(index.items[w])
                    own = np.stack([start[lo:hi] - begin, start[lo:hi] - begin + index.lengths[found]], axis=1)
                    old = np.frombuffer(olds[row].as_py() or b"", np.int64).reshape(-1, 2)
                    own = _merged(np.concatenate([old, own]))
                    n_words.append(size)
                    n_hit.append(int((own[:, 1] - own[:, 0]).sum()))
                    spans.append(own.tobytes())
                    items.append(sorted(names))
                    begin, row = begin + size + 1, row + 1
            state = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([texts, batch.column(1), *state], batch.schema.names)

    return rows.mapInArrow(of_batches, rows.schema)


def scan_benchmark(docs: DataFrame, text_col: str, carried: Column, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of `_text`, `_carried`, `_n_words`, `_n_hit`, `_spans` (packed int64 pairs of words) and `_items`."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.distinct()  # equal rows hash to one block, whatever their number
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    rows = docs.select(F.col(text_col).alias("_text"), carried.alias("_carried"))
    state = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in _STATE])
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about block_bytes
        index = build_index(sorted((r["item_id"], r["text"]) for r in part), window)
        counts = {s: np.zeros(len(keys), np.int64) for s, keys in index.shingles.items()}
        if index.windows:
            for r in _count(rows, spark.sparkContext.broadcast(cloudpickle.dumps(index))).groupBy("size", "place").agg(F.sum("n").alias("n")).collect():
                counts[r["size"]][r["place"]] = r["n"]  # at most one row per shingle of the block
        choose_anchors(index, counts)
        state = _scan(state, spark.sparkContext.broadcast(cloudpickle.dumps(index)))
    return state


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated."""
    found = scan_benchmark(docs, text_col, F.col(id_col), benchmark, window, block_bytes)
    return found.select(
        F.col("_carried").alias("doc_id"),
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sort_array("_items").alias("items"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of `docs` in which no benchmark window occurs."""
    whole = F.struct(*[F.col(c) for c in docs.columns])
    return scan_benchmark(docs, text_col, whole, benchmark, window).filter("_n_hit = 0").select("_carried.*")


def op2_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{d}/benchmark.parquet"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")
