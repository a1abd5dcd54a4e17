"""Probability of whole texts under an online logistic mix of hashed-context bit predictors.

A text is its lower-cased UTF-8 bytes and one end symbol. A symbol is a path of binary decisions in a Huffman
tree over the training bytes, some four instead of eight. Every decision has one predictor per context (the
last three or five bytes; the current word so far): a slot of a hashed table, addressed by context
and tree node, whose counts of both outcomes are gathered from all training texts by one shuffle. The
predictors' log odds are combined by weights that a gate selects (which of the longer contexts were ever
seen), the result is refined by a map from its own log odds to observed frequencies. Weights and map start
afresh in every text and learn online, block by block of `BLOCK` bytes, so a decision's probability depends
on the training counts and on what stands before it in the text only: the product is a distribution over
texts, the same wherever and with whichever neighbours a text is scored.

The base is an add-one unigram model over words and one end per text.

Tables have a fixed number of slots of one byte, so what is broadcast does not grow; counting sees all
training rows, and what a task sends on is bounded by the tables, not by the rows. Word counts, which do
grow, are broadcast for the most frequent words and joined for all others (see token_sums.py).

Defined cases: a NULL text is empty: one end token, scored by both models. A NULL id is not held out. Without
training rows all counts are zero (base score 0, as its denominator is then 1; an untrained mix otherwise).
Repeated rows each get a result and all train. An empty table gives an empty result. Other columns do not
matter, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.staging import stage
from .token_sums import groups, token_sums

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

END = 0xFF  # no byte of UTF-8; also what stands before a text
BACK = 12  # bytes that contexts look back
CONTEXTS = 3
TABLE_BITS = 22
SCALE = 16.0  # table bytes per unit of log odds
PRIOR = 0.4  # added to both outcomes of a slot
_SCORED_BYTES = 4 << 20  # of text that is sorted by length and scored
BLOCK, LANES = 256, 64  # what a block of all lanes needs stays near a core
GATES, BUCKETS = 4, 32
WEIGHT, WEIGHT_RATE = 0.4, 0.6
MAP_PRIOR = 40.0  # decisions that the map's start value weighs
_HASH_BYTES, _TRAIN_BYTES = 1 << 14, 3 << 20  # hashed together; counted together
_PART_BITS = 14  # slots of a table that are summed together
_FAN_IN = 256  # tasks whose counts are summed at first
_END_TOKEN = b" "  # words never hold a blank
_GROUP_BYTES = 1 << 20  # of text split into words together


@dataclass
class Code:
    """Paths of the symbols through the tree: of symbol s from first[s] on, length[s] decisions.

    `nodes` holds the hash of each decision's node, `turns` the side that is taken.
    """

    nodes: np.ndarray
    turns: np.ndarray
    first: np.ndarray
    length: np.ndarray


_NODE_HASH = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


def huffman(counts: list[int]) -> Code:
    """A code with a path for all 256 symbols; ties are broken by number."""
    heap = [(n + 1, s) for s, n in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    new = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]], parent[b[1]] = (new, 0), (new, 1)
        heapq.heappush(heap, (a[0] + b[0], new))
        new += 1
    nodes, turns, first, length = [], [], [], []
    for s in range(256):
        path, at = [], s
        while at in parent:
            at, turn = parent[at]
            path.append((at - 256, turn))
        first.append(len(nodes))
        length.append(len(path))
        nodes += [n for n, _ in reversed(path)]
        turns += [t for _, t in reversed(path)]
    return Code(_NODE_HASH[nodes], np.array(turns, np.uint8), np.array(first, np.int64), np.array(length, np.int64))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint32(salt)) * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    return x ^ (x >> np.uint32(13))


_STEP = 0x01000193  # per byte of the word so far
_UNSTEP = pow(_STEP, -1, 1 << 32)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # the powers of both, of as many places as were needed so far


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_STEP ** (i + 2) and _UNSTEP ** i for i < n, modulo 2^32."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        up, down = np.full(2 * n, _STEP, np.uint32), np.full(2 * n, _UNSTEP, np.uint32)
        up[0], down[0] = _STEP * _STEP & 0xFFFFFFFF, 1
        _POWERS[0] = (np.cumprod(up, dtype=np.uint32), np.cumprod(down, dtype=np.uint32))
    up, down = _POWERS[0]
    return up[:n], down[:n]


def _word_so_far(raw: np.ndarray) -> np.ndarray:
    """Of every place from BACK on: the sum of (byte + 1) * _STEP ** (distance + 1) over the word bytes right before it, BACK at most.

    One running sum serves all words: powers of the inverse of _STEP make the summands alike, and what stands before a
    word is taken off.
    """
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint32)
    np.cumsum((raw + np.uint32(1)) * down, dtype=np.uint32, out=sums[1:])
    breaks = np.flatnonzero(raw - np.uint8(33) >= np.uint8(END - 33))  # not above 32, or END
    breaks += 1
    begins = np.concatenate(([0], breaks))
    begin = begins.repeat(np.diff(begins, append=len(raw)))[BACK:]
    np.maximum(begin, np.arange(len(begin)), out=begin)
    return (sums[BACK:-1] - sums.take(begin)) * up[BACK - 1 : -1]


def contexts(raw: np.ndarray) -> list[np.ndarray]:
    """Hash of every context before each place of `raw` from BACK on."""
    n = len(raw) - BACK
    four = np.ndarray((n,), ">u4", raw, BACK - 4, (1,)).astype(np.uint32)  # the last byte lowest
    five = four * np.uint32(0x2545F491)
    five ^= raw[BACK - 5 : BACK - 5 + n]
    four &= np.uint32(0xFFFFFF)
    return [_mixed(four, 1), _mixed(five, 2), _mixed(_word_so_far(raw), 3)]


def _decisions(raw: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every decision of the symbols of `raw`: its symbol's place, node hash and turn."""
    lengths = code.length[raw]
    of = np.repeat(np.arange(len(raw)), lengths)
    flat = (code.first[raw] - (np.cumsum(lengths) - lengths))[of]
    flat += np.arange(len(flat))
    return of, code.nodes[flat], code.turns[flat]


_SHIFT = np.uint32(32 - TABLE_BITS)


def _slots(hashes: np.ndarray, of: np.ndarray, node_hash: np.ndarray) -> np.ndarray:
    slots = hashes[of]
    slots += node_hash
    slots >>= _SHIFT
    return slots


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


_PAD = bytes([END])


def _framed(raw: bytes) -> np.ndarray:
    return np.frombuffer(_PAD * BACK + raw + _PAD, np.uint8)


class Scorer:
    """The trained model; `tables` holds the log odds of every context's slots in units of 1 / SCALE."""

    def __init__(self, tables: np.ndarray, code: Code):
        self.tables, self.code = tables, code
        self.by_length = np.argsort(-code.length, kind="stable")  # symbols, those of the longest paths first
        self.rank = np.empty(256, np.uint8)
        self.rank[self.by_length] = np.arange(256)
        lengths = code.length[self.by_length]
        self.deeper = [int((lengths > depth).sum()) for depth in range(lengths[0])]  # how many symbols have more decisions
        at = np.concatenate([code.first[self.by_length[:m]] + depth for depth, m in enumerate(self.deeper)])
        self.nodes, self.turns = code.nodes[at], code.turns[at]  # of all symbols by depth
        self.start_map = 1 / (1 + np.exp(-((np.arange(BUCKETS) + 0.5) / 2 - BUCKETS / 4))).astype(np.float32)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """log10 probabilities. Texts are scored side by side, the longest first; where one ends, the next takes its lane."""
        framed = [_PAD * BACK + lowered(t) + _PAD for t in texts]
        result = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: (-len(framed[i]), i))
        result[order] = self._score_lanes([framed[i] for i in order])
        return result

    def _score_lanes(self, framed: list[bytes]) -> np.ndarray:
        """Of every text, in the order in which they get a lane.

        A block's decisions stand by depth in the tree: the first ones of all symbols, then the second ones of those
        that have one, and so on. With the symbols in falling order of their path's length, all that belongs to a depth
        is a run of the symbols. Equal symbols stand together, so nodes and turns are repeated, not looked up; they alternate
        between the lanes, so sums by lane do not wait for each other.
        Indices are known to be inside, and taken with "clip", which looks up faster.
        """
        result = np.zeros(len(framed))
        unit = 1 / SCALE  # a power of two: inputs stay in units of the tables, the weights take the factor without rounding
        new_weights, new_seen, new_hits = np.float32(WEIGHT) * np.float32(unit), np.float32(MAP_PRIOR), self.start_map * np.float32(MAP_PRIOR)
        live, begun, width = min(LANES, len(framed)), min(LANES, len(framed)), BACK + BLOCK
        text, at = list(range(live)), [BACK] * live  # of every lane: its text, and the place its next block begins
        weights = np.full((CONTEXTS, live, GATES), new_weights, np.float32)
        seen = np.full((live, BUCKETS), new_seen, np.float32)
        hits = np.tile(new_hits, (live, 1))
        logs = np.zeros(live)
        lane_of = None
        while live:
            if lane_of is None:  # by place in the block times lanes, plus lane
                lane_of = np.tile(np.arange(live, dtype=np.uint16), BLOCK)
                place_of = (np.arange(BLOCK)[:, None] + np.arange(live) * width).ravel()
            pieces = [framed[t][a - BACK : a + BLOCK] for t, a in zip(text, at)]
            at = [a + BLOCK for a in at]
            ended = [(i, len(pieces[i]) - BACK) for i in range(live) if at[i] >= len(framed[text[i]])]
            for i, _ in ended:
                pieces[i] = pieces[i].ljust(width, _PAD)
            rows = np.frombuffer(b"".join(pieces), np.uint8).reshape(live, width)
            ranks = self.rank.take(rows[:, BACK:].T)  # by place in the block, then lane
            order = np.argsort(ranks, axis=None, kind="stable")
            if any(size < BLOCK for _, size in ended):
                inside = np.ones((BLOCK, live), bool)
                for i, size in ended:
                    inside[size:, i] = False
                order = order[inside.ravel().take(order)]
                ranks = ranks[inside]
            n = np.bincount(ranks.ravel(), minlength=256)  # of every symbol
            so_far = np.cumsum(n)
            runs = [int(so_far[m - 1]) for m in self.deeper]  # how many symbols have more than 0, 1, ... decisions
            place = place_of.take(order, mode="clip")

            def by_depth(x: np.ndarray) -> np.ndarray:
                return np.concatenate([x[:m] for m in runs if m])

            times = np.concatenate([n[:m] for m in self.deeper])
            node_hash, turn = self.nodes.repeat(times), self.turns.repeat(times)
            inputs = []
            for k, hashes in enumerate(contexts(rows.ravel())):
                slots = by_depth(hashes.take(place, mode="clip"))
                slots += node_hash
                slots >>= _SHIFT
                inputs.append(self.tables[k].take(slots, mode="clip"))
            ever = (inputs[1] != 0).view(np.uint8)  # which of the longer contexts were ever seen
            for k in range(2, CONTEXTS):
                ever = ever + (inputs[k] != 0).view(np.uint8) * np.uint8(k)
            lane = by_depth(lane_of.take(order, mode="clip"))
            cell = lane * np.uint16(GATES)
            cell += ever
            gate = cell.astype(np.intp)
            inputs = [x.astype(np.float32) for x in inputs]
            mix = weights[0].take(gate, mode="clip")
            mix *= inputs[0]
            for k in range(1, CONTEXTS):
                part = weights[k].take(gate, mode="clip")
                part *= inputs[k]
                mix += part
            np.minimum(mix, np.float32(7.9), out=mix)
            np.maximum(mix, np.float32(-7.9), out=mix)
            p = np.exp(-mix)
            p += 1
            np.divide(1, p, out=p)
            mix *= 2
            mix += np.float32(BUCKETS / 2)
            bucket = mix.astype(np.uint8)
            lane *= np.uint16(BUCKETS)
            lane += bucket
            refined = (hits / seen).take(lane, mode="clip")
            refined += p
            refined *= np.float32(0.5)
            turned = turn.astype(np.float32)
            error = turned - p
            np.subtract(1 - turned, refined, out=refined)
            np.abs(refined, out=refined)
            by_gate = np.bincount(gate, weights=np.log(refined, out=refined), minlength=live * GATES)
            logs += by_gate.reshape(live, GATES).sum(axis=1)
            cell *= np.uint16(2 * BUCKETS)
            bucket *= np.uint8(2)
            bucket += turn
            cell += bucket
            cells = np.bincount(cell, minlength=live * GATES * 2 * BUCKETS).reshape(live, GATES, 2 * BUCKETS)
            count = cells.sum(axis=2) + 4.0
            for k in range(CONTEXTS):
                inputs[k] *= error
                step = np.bincount(gate, weights=inputs[k], minlength=live * GATES).reshape(live, GATES) / count
                weights[k] += (WEIGHT_RATE * unit * unit * step).astype(np.float32)
            both = cells.sum(axis=1).reshape(live, BUCKETS, 2).astype(np.float32)
            seen += both[:, :, 0] + both[:, :, 1]
            hits += both[:, :, 1]
            gone = []
            for i, _ in ended:
                result[text[i]] = logs[i]
                if begun < len(framed):
                    text[i], at[i], logs[i] = begun, BACK, 0
                    weights[:, i], seen[i], hits[i] = new_weights, new_seen, new_hits
                    begun += 1
                else:
                    gone.append(i)
            if gone:
                left = [i for i in range(live) if i not in gone]
                live, lane_of = len(left), None
                text, at = [text[i] for i in left], [at[i] for i in left]
                weights, seen, hits, logs = weights[:, left], seen[left], hits[left], logs[left]
        return result / math.log(10)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of lower-cased texts, NULL where there are none; white space is that of ASCII."""
    inner = pc.ascii_trim_whitespace(texts)
    return pc.ascii_split_whitespace(pc.if_else(pc.greater(pc.binary_length(inner), 0), inner, pa.scalar(None, inner.type)))


def _token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows: words, the end of every text as a token, and symbols (see `_symbol_counts`)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of_words() -> pa.RecordBatch:
            found = pa.chunked_array(words, pa.string()).value_counts()
            return pa.RecordBatch.from_arrays([found.field(0).cast(pa.binary()), found.field(1)], ["token", "c"])

        words, held, ends, symbols = [], 0, 0, np.zeros(256, np.int64)
        for batch in batches:
            for lo, hi in groups(batch.column(0), _GROUP_BYTES, len(batch)):
                lower = pc.ascii_lower(batch.column(0).slice(lo, hi - lo))
                words.append(words_of(lower).flatten())
                symbols += np.bincount(np.frombuffer(b"".join(lower.cast(pa.binary()).to_pylist()), np.uint8), minlength=256)
                ends += len(lower)
                held += len(words[-1])
                if held >= 1 << 22:
                    yield of_words()
                    words, held = [], 0
        yield of_words()
        symbols[END] = ends
        counts = {_END_TOKEN: ends} | {_END_TOKEN + bytes([s]): int(n) for s, n in enumerate(symbols)}
        yield pa.RecordBatch.from_arrays([pa.array([t for t in counts if counts[t]], pa.binary()), pa.array([n for n in counts.values() if n], pa.int64())], ["token", "c"])

    return texts.mapInArrow(of_batches, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _is_symbol(token: Column) -> Column:
    """A blank and one byte more."""
    return (F.length(token) == 2) & (F.substring(token, 1, 1) == F.lit(_END_TOKEN))


def _symbol_counts(counts: DataFrame) -> list[int]:
    found = [0] * 256
    for r in counts.filter(_is_symbol(F.col("token"))).collect():  # at most 256 rows
        found[r["token"][1]] = r["c"]
    return found


_ENTRIES = {n: np.dtype([("at", "<u2"), ("turn", f"<u{n}", 2)]) for n in (2, 4)}  # by bytes of a count


def _slot_odds(texts: DataFrame, code: Code) -> DataFrame:
    """(part, odds): log odds of the slots of every part of the tables, from the outcomes in all rows.

    A task sends each part's used slots as one packed row. Parts are summed for _FAN_IN tasks at a time and
    then over those sums, so that no group holds more than that many rows of bounded size.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CONTEXTS, 2 << TABLE_BITS), np.int32)

        def in_parts() -> Iterator[list[np.ndarray]]:
            """Texts put together, and longer ones in parts that overlap by BACK bytes."""
            parts, held = [], 0
            for batch in batches:
                for text in batch.column(0):
                    framed = _framed(lowered(text.as_py()))
                    for at in range(BACK, len(framed), _HASH_BYTES):
                        parts.append(framed[at - BACK : at + _HASH_BYTES])
                        held += len(parts[-1])
                        if held >= _HASH_BYTES:
                            yield parts
                            parts, held = [], 0
            if parts:
                yield parts

        def count_all() -> None:
            symbol = np.concatenate(symbols)
            symbols.clear()
            order = np.argsort(symbol, kind="stable")
            symbol = symbol.take(order, mode="clip")
            begins = np.append(True, symbol[1:] != symbol[:-1])
            bounds = [*np.flatnonzero(begins).tolist(), len(symbol)]
            for k, waiting in enumerate(hashes):
                found = np.concatenate(waiting).take(order, mode="clip")
                waiting.clear()
                for lo, hi in pairwise(bounds):
                    found[lo:hi].sort()  # a symbol that follows the same context again takes the same slots
                first = np.flatnonzero(np.append(True, found[1:] != found[:-1]) | begins)
                n = np.diff(first, append=len(found)).astype(np.int32)
                of, node_hash, turn = _decisions(symbol.take(first), code)
                slots = _slots(found.take(first), of, node_hash).astype(np.int64)
                slots *= 2
                slots += turn
                np.add.at(total[k], slots, n.take(of))

        hashes: list[list[np.ndarray]] = [[] for _ in range(CONTEXTS)]
        symbols: list[np.ndarray] = []
        held = 0
        for parts in in_parts():
            raw = np.concatenate(parts)
            inside = np.ones(len(raw), bool)
            starts = np.append(0, np.cumsum([len(p) for p in parts])[:-1])
            for j in range(BACK):
                inside[starts + j] = False
            counted = np.flatnonzero(inside[BACK:])
            symbols.append(raw[BACK:].take(counted))
            for waiting, found in zip(hashes, contexts(raw)):
                waiting.append(found.take(counted))
            held += len(counted)
            if held >= _TRAIN_BYTES:
                count_all()
                held = 0
        if held:
            count_all()
        some = TaskContext.get().partitionId() // _FAN_IN
        for part, pairs in enumerate(total.reshape(-1, 1 << _PART_BITS, 2)):
            used = np.flatnonzero(pairs.view(np.int64))  # both outcomes as one number
            found = pairs.take(used, axis=0)
            size = 2 if found.max(initial=0) < 1 << 16 else 4
            entries = np.empty(len(used), _ENTRIES[size])
            entries["at"], entries["turn"] = used, found
            columns = [pa.array([some], pa.int64()), pa.array([part], pa.int64()), pa.array([size], pa.int64()), pa.array([entries.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["some", "part", "size", "entries"])

    def of_tasks(rows: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros((1 << _PART_BITS, 2), np.int64)
        for size, packed in zip(rows["size"], rows["entries"]):
            entries = np.frombuffer(packed, _ENTRIES[size])
            sums[entries["at"]] += entries["turn"]
        return pd.DataFrame({"part": rows["part"].iloc[:1], "sums": [sums.tobytes()]})

    def of_sums(rows: pd.DataFrame) -> pd.DataFrame:
        sums = sum(np.frombuffer(x, np.int64) for x in rows["sums"]).reshape(-1, 2)
        odds = np.rint(np.log((sums[:, 1] + PRIOR) / (sums[:, 0] + PRIOR)) * SCALE)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "odds": [np.clip(odds, -127, 127).astype(np.int8).tobytes()]})

    rows = texts.mapInArrow(of_batches, "some long, part long, size long, entries binary")
    sums = rows.groupBy("some", "part").applyInPandas(of_tasks, "part long, sums binary")
    return sums.groupBy("part").applyInPandas(of_sums, "part long, odds binary")


def train(texts: DataFrame, symbols: list[int]) -> Scorer:
    """Count all rows of the one column of `texts`; the driver gets one byte per used slot, of a fixed number of slots."""
    code = huffman(symbols)
    tables = np.zeros((CONTEXTS << (TABLE_BITS - _PART_BITS), 1 << _PART_BITS), np.int8)
    for r in _slot_odds(texts, code).collect():  # all parts together: CONTEXTS tables of 2^TABLE_BITS bytes
        tables[r["part"]] = np.frombuffer(r["odds"], np.int8)
    return Scorer(tables.reshape(CONTEXTS, -1), code)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    training = rows.filter(~held_out(F.col("doc_id"))).select("text")
    all_counts = stage(_token_counts(training))
    counts = all_counts.filter(~_is_symbol(F.col("token")))
    ends = F.coalesce(F.max(F.when(F.col("token") == F.lit(_END_TOKEN), F.col("c"))), F.lit(0))
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), ends.alias("ends")).first()
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(train(training, _symbol_counts(all_counts))))

    def of_texts():
        def of_group(texts: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
            words = words_of(pc.ascii_lower(texts))
            return words, np.column_stack([pc.list_value_length(words).fill_null(0).to_numpy() + 1, pc.binary_length(texts).to_numpy()])

        return of_group

    scorers: list[Scorer] = []  # one in each task

    def of_block(texts: list[str]) -> np.ndarray:
        if not scorers:
            scorer = pickle.loads(shared.value)
            scorers.append(Scorer(scorer.tables.copy(), scorer.code))  # a copy lies on large pages, which look-ups all over it need
        return scorers[0].score(texts)

    n, v, end = totals["n"], totals["v"], totals["ends"]  # the end, one in every text, is added below
    known = counts.select("token", F.col("c").alias("value"), F.col("c").alias("n"))
    sums = [(lambda c: np.ones(len(c)), F.lit(1)), (lambda c: np.log10(c + 1.0), F.log10(F.col("value") + 1.0))]
    found = token_sums(rows, of_texts, known, sums, of_block, block_bytes=_SCORED_BYTES, group_bytes=_SCORED_BYTES, stored=True)
    n_tokens, n_bytes, score = (F.col("numbers")[i] for i in range(3))
    made = found.select(
        "doc_id",
        n_tokens.cast("long").alias("n_tokens"),
        (F.col("s0") + F.lit(min(end, 1))).cast("long").alias("n_known"),
        (F.col("s1") + math.log10(end + 1) - n_tokens * math.log10(n + v + 1)).alias("base_score"),
        score.alias("score"),
        (-score * math.log2(10) / F.greatest(n_bytes, F.lit(1.0))).alias("bits_per_byte"),
    )
    return made.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        "base_score", "score", "bits_per_byte",
    )


def op4_language_model(spark: SparkSession, d: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{d}/documents.parquet"))
