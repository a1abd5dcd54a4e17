"""Byte-level byte-pair encoding and decoding of whole texts.

A long text is cut into overlapping chunks that are pre-tokenised in parallel. Where the next pre-token
begins depends only on the text that follows, so as soon as two neighbours have a boundary in common they
agree from there on: the first common one in their overlap is the seam. Chunks without a common boundary
(one pre-token longer than the overlap) are put together and pre-tokenised again. The pieces between the
seams are encoded in parallel, and the ids joined in order. Texts of one chunk take none of these steps.

Encoding a pre-token merges its best-ranked pair of neighbours until none is left; decoding concatenates
the bytes of the ids.

Defined cases: a NULL text is empty; an empty text has no ids. Repeated rows each get a result, NULL ids are
carried along. An empty table gives an empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 11
LOOKAHEAD = 4  # characters behind a pre-token that its end may depend on
CACHED = 1 << 19  # pre-tokens remembered by a task, some 150 MB
SHORT = 32  # bytes up to which looking through all pairs beats a heap


class Encoder:
    """Ranks, and the pre-tokens of this task that were encoded already."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.spans = regex.compile(pattern).finditer
        self.seen: dict[str, tuple[str, tuple[int, ...]]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: its neighbours with the lowest rank merge, the first ones on ties, until none can."""
        if piece in self.ranks:
            return (self.ranks[piece],)
        if len(piece) > SHORT:
            return self._merge_long(piece)
        rank_of, none = self.ranks.get, len(self.ranks)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank_of(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (low := min(pairs)) < none:
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank_of(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + parts[at], none)
        return tuple(self.ranks[part] for part in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Neighbours are a linked list, candidate pairs a heap: n log n for any length."""
        rank_of, n = self.ranks.get, len(piece)
        end, last = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts here
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, stop = heapq.heappop(heap)
            middle = end[at]
            if middle == 0 or middle >= n or end[middle] != stop or middle == stop:
                continue  # one of the two parts is gone or has grown
            end[at], end[middle] = stop, 0
            if stop < n:
                last[stop] = at
                if (r := rank_of(piece[at : end[stop]])) is not None:
                    heapq.heappush(heap, (r, at, end[stop]))
            if last[at] >= 0 and (r := rank_of(piece[last[at] : stop])) is not None:
                heapq.heappush(heap, (r, last[at], stop))
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return tuple(ids)

    def encode(self, text: str) -> tuple[str, list[int]]:
        """The ids as text, joined by commas, and as numbers."""
        seen, written, numbers = self.seen, [], []
        for piece in self.split(text):
            known = seen.get(piece)
            if known is None:
                if len(seen) >= CACHED:
                    seen.clear()
                ids = self.merge(piece.encode("utf-8", "surrogatepass"))
                known = seen[piece] = (",".join(map(str, ids)), ids)
            written.append(known[0])
            numbers.append(known[1])
        return ",".join(written), list(chain.from_iterable(numbers))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def boundaries(self, text: str, ends_here: bool) -> list[int]:
        """Ends of pre-tokens; those that what follows the chunk might change are left out."""
        trusted = len(text) if ends_here else len(text) - LOOKAHEAD
        return [0, *(e for m in self.spans(text) if (e := m.end()) <= trusted)]


def _whole(rows: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            counts, written, decoded = [], [], []
            for text in batch.column(1):
                as_text, ids = encoder.encode(text.as_py() or "")
                counts.append(len(ids))
                written.append(hashlib.sha256(as_text.encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(written), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(of_batches, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, at, text, last): overlapping pieces of every text, dealt out evenly."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0), batch.column(1), batch.column(2)):
                text = text.as_py()
                starts = list(range(0, max(1, len(text) - overlap), chunk))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()] * len(starts), pa.int64()),
                        pa.array([doc_id.as_py()] * len(starts), doc_id.type),
                        pa.array(starts, pa.int64()),
                        pa.array([text[s : s + chunk + overlap] for s in starts]),
                        pa.array([s == starts[-1] for s in starts]),
                    ],
                    ["row", "doc_id", "at", "text", "last"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return keyed.mapInArrow(of_batches, f"row long, doc_id {kind}, at long, text string, last boolean").repartition("row", "at")


def _with_boundaries(chunks: DataFrame, vocabulary: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Add the chunk's boundaries in the overlap before it (`head`) and behind it (`tail`), as places in the text."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            heads, tails = [], []
            for at, text, last in zip(batch.column(2), batch.column(3), batch.column(4)):
                ends = encoder.boundaries(text.as_py(), last.as_py())
                heads.append([at.as_py() + e for e in ends if e <= overlap])
                tails.append([at.as_py() + e for e in ends if e >= chunk])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "head", "tail"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema)
    return chunks.mapInArrow(of_batches, f"{fields}, head array<long>, tail array<long>")


def _long(rows: DataFrame, vocabulary: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    found = _with_boundaries(_chunks(rows, chunk, overlap), vocabulary, pattern, chunk, overlap)
    in_text = Window.partitionBy("row").orderBy("at")  # the chunks of one text
    seam = F.array_min(F.array_intersect("head", F.lag("tail").over(in_text)))
    found = found.withColumn("seam", F.when(F.col("at") == 0, F.lit(0).cast("long")).otherwise(seam))
    # Behind a missing seam nothing is certain: the rest of the text is one piece.
    broken = F.max(F.col("seam").isNull()).over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn("seam", F.when(~broken, F.col("seam")))
    piece = F.max("seam").over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn("piece", piece).withColumn("stop", F.lead("seam").over(in_text)).drop("head", "tail")

    encoders: list[Encoder] = []  # filled once per task

    def encode(chunks: pd.DataFrame) -> pd.DataFrame:
        """One piece: a chunk from its seam to the next, or all chunks behind a missing seam."""
        if not encoders:
            encoders.append(Encoder(vocabulary, pattern))
        encoder = encoders[0]
        chunks = chunks.sort_values("at")
        start, stop = int(chunks["piece"].iloc[0]), chunks["stop"].iloc[-1]
        text = "".join(t if last else t[:chunk] for t, last in zip(chunks["text"][:-1], chunks["last"][:-1])) + chunks["text"].iloc[-1]
        base = int(chunks["at"].iloc[0])
        written, ids = encoder.encode(text[start - base : None if pd.isna(stop) else int(stop) - base])
        return pd.DataFrame({"row": chunks["row"].iloc[:1], "doc_id": chunks["doc_id"].iloc[:1], "piece": [start], "ids": [written], "n": [len(ids)], "bytes": [encoder.decode(ids)]})

    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = found.groupBy("row", "piece").applyInPandas(encode, f"row long, doc_id {kind}, piece long, ids string, n long, bytes binary")
    part = F.struct("piece", "ids", "bytes")
    joined = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("p"))
    return joined.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.filter(F.col("p.ids"), lambda x: x != ""), ","), 256).alias("ids_sha256"),
        F.sha2(F.unhex(F.array_join(F.transform("p.bytes", lambda b: F.hex(b)), "")), 256).alias("decoded_sha256"),
    )


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    pattern: str | None = None,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded bytes).

    `vocabulary` is a file of ranks that every executor can open, `pattern` splits texts into pre-tokens.
    `overlap` must be less than `chunk`.
    """
    vocabulary, pattern = vocabulary or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    is_long = F.length("text") > chunk
    return _whole(rows.filter(~is_long), vocabulary, pattern).unionByName(_long(rows.filter(is_long), vocabulary, pattern, chunk, overlap))


def op5_byte_pairs(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{d}/documents.parquet"))
