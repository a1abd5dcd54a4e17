"""Sums over the tokens of documents, of values that a table of tokens gives, for a table of any size.

Most tokens of a text are among few distinct ones. The most frequent tokens, a bounded number of them (`HEAD`), are
broadcast as two arrays, 64-bit keys and values, and summed where the text is read. Only tokens beyond the head
travel: a row of key and frequency for each document that holds one, joined to the rest of the table and summed per
document. Being rare, none of them is a hot key. The result does not depend on the size of the head.

Keys are hashes that are checked to be unique among the table's tokens; if two tokens shared one, all would be hashed anew.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

HEAD = 1 << 20  # tokens that are broadcast, 16 bytes each
BLOCK_BYTES = 16 << 20  # of text that is taken together
BLOCK_ROWS = 1 << 15
_REMEMBERED = 1 << 19  # tokens whose place a task remembers
GROUP_BYTES = 1 << 20  # of text whose tokens are looked up together
_EXACT, _STEPS = 1024, 8  # frequencies up to the first are told apart, beyond it some steps per doubling


def _step(n: Column) -> Column:
    """A step that never falls with the frequency, and of which there are few."""
    beyond = F.floor(F.log2(n.cast("double") / _EXACT) * _STEPS).cast("long")
    return F.when(n <= _EXACT, n).otherwise(F.lit(_EXACT) + beyond)


def keyed(tokens: DataFrame, stored: bool = False) -> tuple[DataFrame, str]:
    """(key, value, n) of (token, value, n) from a stored table, and the salt that makes the keys unique. `stored`: it is one."""
    tokens = tokens.select(F.col("token").cast("binary").alias("token"), F.col("value").cast("long").alias("value"), F.col("n").cast("long").alias("n"))
    if not stored:
        tokens = stage(tokens)
    salt = ""
    while True:
        found = tokens.select(F.xxhash64(F.concat(F.lit(salt).cast("binary"), F.col("token"))).alias("key"), "value", "n")
        if found.groupBy("key").count().filter("count > 1").isEmpty():
            return found, salt
        salt += "+"


def split_head(tokens: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Keys in order and values of the most frequent tokens, at most `head`, and the table of all others."""
    steps = tokens.groupBy(_step(F.col("n")).alias("step")).count().collect()  # at most some 1,500 rows
    least, held = None, 0
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["count"]
        if held > head:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), tokens.select("key", "value")
    top = tokens.filter(_step(F.col("n")) >= least).select("key", "value").toArrow()  # at most `head` rows
    keys, values = (top.column(c).to_numpy() for c in ("key", "value"))
    order = np.argsort(keys)
    return keys[order], values[order], tokens.filter(_step(F.col("n")) < least).select("key", "value")


def groups(texts: pa.Array, most_bytes: int, most_rows: int) -> Iterator[tuple[int, int]]:
    """Bounds of groups of rows, each ended by the row that makes it reach one of the two numbers."""
    begun, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist(), 1):
        held += size
        if held >= most_bytes or i - begun >= most_rows:
            yield begun, i
            begun, held = i, 0
    if begun < len(texts):
        yield begun, len(texts)


class Places:
    """Numbers the tokens of a group of texts, and looks up all new ones together: their keys and their places in the head, or -1."""

    def __init__(self, head_keys: np.ndarray, salt: str):
        self.head_keys, self.salt = head_keys, salt.encode()
        self.forget()

    def forget(self) -> None:
        self.numbers: defaultdict = defaultdict(count().__next__)
        self.keys, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look_up(self, tokens: list | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        digest, salt = xxhash.xxh64_intdigest, self.salt
        raw = tokens if isinstance(tokens, np.ndarray) else [token if isinstance(token, bytes) else token.encode("utf-8", "surrogatepass") for token in tokens]
        if salt:
            raw = [salt + token for token in raw]
        keys = np.fromiter(map(digest, raw, repeat(42)), np.uint64, len(raw)).view(np.int64)
        order = np.argsort(keys)  # keys in order meet the head in order
        inside = keys.take(order)
        found = np.searchsorted(self.head_keys, inside)
        if len(self.head_keys):
            found[self.head_keys.take(found, mode="clip") != inside] = -1
        else:
            found[:] = -1
        places = np.empty_like(found)
        places[order] = found
        return keys, places

    def of_arrow(self, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How many tokens each text has, their numbers, and by number their keys and places."""
        found = tokens.flatten().dictionary_encode()
        lengths = pc.list_value_length(tokens).fill_null(0).to_numpy().astype(np.int64)
        return lengths, found.indices.to_numpy(), *self.look_up(found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False))

    def of_lists(self, tokens: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same; tokens met before are remembered, a bounded number of them."""
        if len(self.numbers) > _REMEMBERED:
            self.forget()
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        found = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(tokens)), np.int32, int(lengths.sum()))
        new = [*islice(reversed(self.numbers), len(self.numbers) - len(self.keys))]
        keys, places = self.look_up(new[::-1])
        self.keys, self.places = np.append(self.keys, keys), np.append(self.places, places)
        return lengths, found, self.keys, self.places


def token_sums(
    rows: DataFrame,
    of_texts: Callable[[], Callable[[pa.Array], tuple[pa.ListArray | list[list], np.ndarray]]],
    tokens: DataFrame,
    sums: list[tuple[Callable[[np.ndarray], np.ndarray], Column]],
    of_block: Callable[[list[str]], np.ndarray] | None = None,
    head: int = HEAD,
    block_bytes: int = BLOCK_BYTES,
    block_rows: int = BLOCK_ROWS,
    group_bytes: int = GROUP_BYTES,
    stored: bool = False,
) -> DataFrame:
    """(doc_id, numbers, s0, s1, ...) of every row of `rows` (doc_id, text; no NULL text).

    `of_texts` is called once per task and gives a function from texts to the tokens and some numbers of each. `of_block`, if
    given, makes one more number per text from a block of texts. `tokens` has token, value (a whole number) and n,
    by which tokens count as frequent. Each of `sums` is a function of a token's value, as NumPy and as column (of `value`); its
    sum is over all tokens of a text that the table holds. `stored` says that `tokens` costs no more than reading a file.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    table, salt = keyed(tokens, stored)
    keys, values, rest = split_head(table, head)
    shared = rows.sparkSession.sparkContext.broadcast((keys, *[np.asarray(of(values), np.float64) for of, _ in sums]))
    names = ["row", "doc_id", "numbers", "known", "key", "n"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_group, number = of_texts(), TaskContext.get().partitionId() << 33
        head_keys, *parts = shared.value
        parts = [np.append(part, 0.0) for part in parts]  # also at -1, for tokens beyond the head
        places = Places(head_keys, salt)
        ids, texts, numbers, known, beyond = [], [], [], [], []  # of a block
        held, count = 0, 0

        def take(group: pa.Array) -> None:
            tokens, own = of_group(group)
            lengths, found, keys, place = (places.of_lists if isinstance(tokens, list) else places.of_arrow)(tokens)
            at = place.take(found)
            summed = np.zeros((len(group), len(parts)))
            full = np.flatnonzero(lengths)
            starts = (np.cumsum(lengths) - lengths)[full]
            for i, part in enumerate(parts):
                if len(full):
                    summed[full, i] = np.add.reduceat(part.take(at), starts)
            other = np.flatnonzero(at < 0)
            row = np.arange(len(group)).repeat(lengths)[other]
            pairs, n = np.unique(row << 32 | found[other], return_counts=True)
            numbers.append(own)
            known.append(summed)
            beyond.append((number + count + (pairs >> 32), keys.take(pairs & 0xFFFFFFFF), n))

        def lists(values: np.ndarray) -> pa.Array:
            width = values.shape[1]
            return pa.ListArray.from_arrays(pa.array(np.arange(0, (len(values) + 1) * width, width), pa.int32()), pa.array(values.ravel(), pa.float64()))

        def out() -> Iterator[pa.RecordBatch]:
            made = np.concatenate(numbers)
            if of_block:
                made = np.column_stack([made, of_block(texts)])
            made, summed = lists(made), lists(np.concatenate(known))
            doc_ids = pa.chunked_array(ids).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(number, number + count)), doc_ids, made, summed, pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64())], names)
            row, key, n = map(np.concatenate, zip(*beyond))
            none = [pa.nulls(len(row), x.type) for x in (doc_ids, made, summed)]
            yield pa.RecordBatch.from_arrays([pa.array(row), *none, pa.array(key), pa.array(n)], names)
            for kept in (ids, texts, numbers, known, beyond):
                kept.clear()

        for batch in batches:
            for lo, hi in groups(batch.column(1), min(block_bytes, group_bytes), block_rows):
                group = batch.column(1).slice(lo, hi - lo)
                take(group)
                ids.append(batch.column(0).slice(lo, hi - lo))
                if of_block:
                    texts += group.to_pylist()
                held += pc.sum(pc.binary_length(group)).as_py()
                count += len(group)
                if held >= block_bytes or count >= block_rows:
                    yield from out()
                    number, held, count = number + count, 0, 0
        if count:
            yield from out()

    made = stage(rows.select("doc_id", "text").mapInArrow(of_batches, f"row long, doc_id {kind}, numbers array<double>, known array<double>, key long, n long"))
    beyond = made.filter(F.col("key").isNotNull()).select("row", "key", "n").join(rest, "key")
    found = beyond.groupBy("row").agg(*[F.sum(of * F.col("n")).cast("double").alias(f"_b{i}") for i, (_, of) in enumerate(sums)])
    whole = made.filter(F.col("key").isNull()).join(found, "row", "left")
    return whole.select("doc_id", "numbers", *[(F.col("known")[i] + F.coalesce(F.col(f"_b{i}"), F.lit(0.0))).alias(f"s{i}") for i in range(len(sums))])
