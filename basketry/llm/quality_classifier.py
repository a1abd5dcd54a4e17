"""Quality score of whole texts: a byte-level convolutional network in NumPy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters run over every
chunk; each filter's largest response is kept (max-pooling) and rectified. The chunks' vectors are combined
by their mean and their maximum, and a logistic layer makes one probability of that.

The network is fitted on a bounded sample: per label the `TRAIN_PER_LABEL` labelled ids with the smallest
hash, among the ids whose crc32 modulo 3 is not 1, of each document all chunks; a long one is pooled in pieces. Scoring reads all bytes of all documents; label, language, source and id are no inputs.

Defined cases: a NULL or empty text is one chunk of padding. Ids labelled more than once take their lowest
label; NULL ids or labels do not train. Without examples of both labels the score of every document is the
smoothed share of label 1. A NULL id is not held out. Repeated rows each get the same score. An empty table
gives an empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

CHUNK, STEP = 256, 192
WIDTH, FILTERS = 5, 24
TRAIN_PER_LABEL = 1200
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.01, 7
_AT_ONCE = 256  # chunks

Network = dict[str, np.ndarray]


def chunks_of(text: str | bytes | None) -> np.ndarray:
    """Overlapping chunks, padded with zero bytes, as rows; the last one ends with the text."""
    raw = np.frombuffer(text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-(len(raw) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def _responses(net: Network, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of every filter in every chunk, and where it is."""
    n = CHUNK - WIDTH + 1
    out = net["filters"][0][chunks[:, :n]]
    for j in range(1, WIDTH):
        out += net["filters"][j][chunks[:, j : j + n]]
    at = out.argmax(axis=1)
    return np.take_along_axis(out, at[:, None], axis=1)[:, 0], at


def score_text(net: Network, text: str | None) -> float:
    chunks = chunks_of(text)
    total, most = np.zeros(FILTERS), np.zeros(FILTERS)
    for at in range(0, len(chunks), _AT_ONCE):
        out = net["filters"][0][chunks[at : at + _AT_ONCE, : CHUNK - WIDTH + 1]]
        for j in range(1, WIDTH):
            out += net["filters"][j][chunks[at : at + _AT_ONCE, j : j + CHUNK - WIDTH + 1]]
        pooled = np.maximum(out.max(axis=1) + net["shift"], 0.0)
        total += pooled.sum(axis=0, dtype=np.float64)
        most = np.maximum(most, pooled.max(axis=0))
    logit = np.concatenate([total / len(chunks), most]) @ net["weights"].astype(np.float64) + float(net["bias"][0])
    return float(1.0 / (1.0 + np.exp(-np.clip(logit, -40.0, 40.0))))


def fit(documents: list[np.ndarray], labels: list[int]) -> Network:
    """Adam on the logistic loss, both labels weighing the same; deterministic for the order given."""
    rng = np.random.default_rng(SEED)
    net: Network = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "shift": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    y_all = np.array(labels)
    weight = {label: len(labels) / (2 * max(1, (y_all == label).sum())) for label in (0, 1)}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(documents))
        for lo in range(0, len(order), BATCH):
            batch = order[lo : lo + BATCH]
            sizes = [len(documents[i]) for i in batch]
            chunks, starts = np.concatenate([documents[i] for i in batch]), np.append(0, np.cumsum(sizes)[:-1])
            pieces = [_responses(net, chunks[lo : lo + _AT_ONCE]) for lo in range(0, len(chunks), _AT_ONCE)]
            value, at = (np.concatenate(x) for x in zip(*pieces))
            pooled = np.maximum(value + net["shift"], 0.0)
            mean = np.add.reduceat(pooled, starts) / np.array(sizes)[:, None]
            most = np.maximum.reduceat(pooled, starts)
            features = np.concatenate([mean, most], axis=1)
            p = 1.0 / (1.0 + np.exp(-np.clip(features @ net["weights"] + net["bias"][0], -40, 40)))
            y = y_all[batch]
            error = (p - y) * np.array([weight[int(v)] for v in y]) / len(batch)
            back = error[:, None] * net["weights"]
            document = np.repeat(np.arange(len(batch)), sizes)
            into = (back[:, :FILTERS] / np.array(sizes)[:, None])[document] + back[:, FILTERS:][document] * (pooled == most[document])
            into = (into * (pooled > 0)).astype(np.float32)
            grad = {
                "filters": np.zeros_like(net["filters"]),
                "shift": into.sum(axis=0),
                "weights": features.T @ error,
                "bias": np.array([error.sum()]),
            }
            row, unit = np.nonzero(into)
            for j in range(WIDTH):
                np.add.at(grad["filters"][j], (chunks[row, at[row, unit] + j], unit), into[row, unit])
            step += 1
            for k in net:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                net[k] -= (RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(rows: DataFrame, labels: DataFrame, per_label: int = TRAIN_PER_LABEL) -> Network | float:
    """A network, or the smoothed share of label 1. `rows`: doc_id, text; `labels`: doc_id, quality."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    draw = F.xxhash64("doc_id")
    sample = usable.filter("quality = 0").orderBy(draw, "doc_id").limit(per_label)
    sample = sample.unionByName(usable.filter("quality = 1").orderBy(draw, "doc_id").limit(per_label))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(text.as_py() or "").encode("utf-8", "surrogatepass") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], ["quality", "bytes"])

    found = rows.join(F.broadcast(sample), "doc_id").select("quality", "text")  # at most 2 * per_label rows
    examples = sorted((r["quality"], bytes(r["bytes"])) for r in found.mapInArrow(of_batches, "quality int, bytes binary").collect())
    answers = [q for q, _ in examples]
    if len(set(answers)) < 2:
        return (sum(answers) + 1) / (len(answers) + 2)
    return fit([chunks_of(raw) for _, raw in examples], answers)  # views of the bytes


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    net = train(rows, labels.select("doc_id", "quality"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [net if isinstance(net, float) else score_text(net, text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(of_batches, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
