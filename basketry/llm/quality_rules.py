"""Quality rules and importance scores, as DataFrame expressions only.

Two parts, both over whole texts:

* counts per document (words, symbols, repeated lines, repeated three-word windows) with a base rule on them;
* an importance score: the mean over a document's hashed word uni- and bigrams of
  log(p_target / p_raw), where p_target and p_raw are smoothed multinomials over hash buckets, counted over
  trusted documents and over all documents. Ids are dealt into `FOLDS` folds by their hash, and a document is scored
  with the counts of the other folds: it is never among what it is held against, so a trusted one has no
  advantage over an unlabelled one of the same kind, however small the corpus.

A document is kept when its score reaches the threshold. That is where the scores of all labelled documents
that pass the base rule part best: the fewest shares of good ones below and of bad ones from there on.

Defined cases: a NULL or empty text has no words and fails the base rule. A NULL id is carried along and is
never trusted; such rows are one fold's. Without trusted documents in the other folds every log ratio is 0, so the base
rule decides alone. Without good or bad labels among the documents that pass the base rule
the threshold is the fixed one. An id labelled both good and bad is good. Repeated rows are scored one by one and get the same
result. Input columns other than id and text do not matter, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RARE_SPACES = "\t\x0b\x0c\r"  # with blank and line feed, the characters between words
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"  # fixed values of the base rule
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # fixed values of the base rule

BUCKET_BITS = 15
THRESHOLD = -0.09  # mean log ratio from which a document is kept where labels do not show one
STEPS, FARTHEST = 1024, 16  # thresholds tried: steps a unit, and units to either side of 0
SMOOTHING = 1.0
FOLDS = 2  # a document is scored with the counts of the other folds
BROADCAST_IDS = 500_000  # labelled ids up to which they are broadcast (about 30 MB, 60 bytes each); more are joined by a shuffle


def _replaced(text: Column, characters: str, instead: str) -> Column:
    """Single characters replaced byte by byte, and only in texts that hold one; far cheaper than a pattern."""
    holds, done = F.lit(False), text
    for c in characters:
        holds, done = holds | F.contains(text, F.lit(c)), F.replace(done, F.lit(c), F.lit(instead))
    return F.when(holds, done).otherwise(text)


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space; `text` should be a plain column."""
    spaced = F.replace(_replaced(F.coalesce(text, F.lit("")), RARE_SPACES, " "), F.lit("\n"), F.lit(" "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _next(array: str, step: int = 1) -> Column:
    """The array without its first `step` elements."""
    return F.slice(array, F.lit(step + 1), F.greatest(F.size(array) - step, F.lit(0)))


def _with_hashes(df: DataFrame) -> DataFrame:
    """Add `_single`, a hash of every word, and `_pairs`, one of every word and its successor (the last word alone)."""
    return df.withColumn("_single", F.transform("_words", lambda w: F.xxhash64(w))).withColumn(
        "_pairs", F.zip_with("_words", _next("_words"), lambda a, b: F.xxhash64(a, b))
    )


def _bucket(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int")


def _with_repeats(df: DataFrame) -> DataFrame:
    """Add `_repeats`: words inside three-word windows that occur at least twice, from `_words` and `_pairs`.

    Where windows repeat, their 64-bit hashes are sorted with their positions inside the row, so a repeated
    one stands next to its like: n log n for any length of text, no shuffle.
    """
    n_windows = F.greatest(F.size("_words") - 2, F.lit(0))
    entries = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    gap = lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))
    return (
        df.withColumn("_windows", F.zip_with(F.slice("_pairs", F.lit(1), n_windows), _next("_words", 2), lambda p, w: F.xxhash64(p, w)))
        .withColumn("_sorted", F.when(repeated, F.sort_array(entries)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
        .withColumn("_like_next", F.zip_with("_sorted", _next("_sorted"), same))
        .withColumn("_like_last", F.slice(F.concat(F.array(F.lit(False)), "_like_next"), F.lit(1), F.size("_like_next")))
        .withColumn("_is_repeat", F.zip_with("_like_next", "_like_last", lambda a, b: a | b))
        .withColumn("_found", F.sort_array(F.array_compact(F.zip_with("_sorted", "_is_repeat", lambda s, r: F.when(r, s["i"])))))
        .withColumn("_repeats", F.aggregate(F.zip_with("_found", _next("_found"), gap), F.lit(0).cast("long"), lambda n, g: n + g))
    )


@dataclass
class BucketCounts:
    """Occurrences per fold and bucket in all documents and in the trusted ones."""

    raw: list[list[int]]
    target: list[list[int]]


def _with_labels(docs: DataFrame, id_col: str, trusted_ids: DataFrame, bad_ids: DataFrame | None = None, how: str = "left") -> DataFrame:
    """`docs` as `_row` and `_trusted`: 1 for trusted ids, 0 for bad ones, NULL for all others.

    The labelled side adds nothing to the shuffle while its ids fit the broadcast bound; beyond it the
    documents are joined by id.
    """
    ids = lambda df, good: df.select(F.col(df.columns[0]).alias("_id"), F.lit(good).alias("_trusted"))
    labels = ids(trusted_ids, 1)
    if bad_ids is not None:
        labels = labels.union(ids(bad_ids, 0))
    labels = labels.filter(F.col("_id").isNotNull()).groupBy("_id").agg(F.max("_trusted").alias("_trusted"))
    rows = docs.select(F.col(id_col).alias("_id"), F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    if labels.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(labels), "_id", how).select("_row", "_trusted")
    found = rows.filter(F.col("_id").isNotNull()).join(labels, "_id", how).select("_row", "_trusted")
    if how == "inner":
        return found
    # Rows without id would all meet in one task.
    return found.union(rows.filter(F.col("_id").isNull()).select("_row", F.lit(None).cast("int")))


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(folds)).cast("int")


def bucket_counts(docs: DataFrame, id_col: str, text_col: str, trusted_ids: DataFrame, bits: int = BUCKET_BITS, folds: int = FOLDS) -> BucketCounts:
    """Counts per fold and bucket from all rows.

    They combine on the map side, so at most `folds` x 2^`bits` rows leave a task and reach the driver, whatever the input.
    """
    rows = _with_labels(docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")), "_doc", trusted_ids)
    words = rows.select(
        fold_of(F.col("_row._doc"), folds).alias("_fold"), F.coalesce("_trusted", F.lit(0)).alias("_trusted"), words_of(F.col("_row._text")).alias("_words")
    )
    counted = (
        _with_hashes(words)
        # The outer form: the inner one gets an inferred filter that would split every text once more.
        .select("_fold", "_trusted", F.explode_outer(F.concat("_single", "_pairs")).alias("_hash"))
        .groupBy(F.col("_fold").alias("fold"), _bucket(F.col("_hash"), bits).alias("bucket"))
        .agg(F.count("_hash").alias("raw"), F.sum("_trusted").alias("target"))
        .filter(F.col("bucket").isNotNull())
        .collect()
    )
    raw, target = ([[0] * (1 << bits) for _ in range(folds)] for _ in range(2))
    for row in counted:
        raw[row["fold"]][row["bucket"]], target[row["fold"]][row["bucket"]] = row["raw"], row["target"]
    return BucketCounts(raw, target)


def _log_ratios(raw: list[int], target: list[int], smoothing: float) -> list[float]:
    buckets = len(raw)
    all_raw, all_target = math.log(sum(raw) + smoothing * buckets), math.log(sum(target) + smoothing * buckets)
    if not sum(target):
        return [0.0] * buckets
    return [round(math.log(t + smoothing) - all_target - math.log(r + smoothing) + all_raw, 6) for r, t in zip(raw, target)]


def bucket_log_ratios(
    docs: DataFrame, id_col: str, text_col: str, trusted_ids: DataFrame, bits: int = BUCKET_BITS, smoothing: float = SMOOTHING
) -> list[float]:
    """log(p_target / p_raw) per bucket, from all rows."""
    counts = bucket_counts(docs, id_col, text_col, trusted_ids, bits, 1)
    return _log_ratios(counts.raw[0], counts.target[0], smoothing)


def cross_ratios(counts: BucketCounts, smoothing: float = SMOOTHING) -> list[float]:
    """log(p_target / p_raw) per fold and bucket, one fold after the other, each from the counts of the other folds."""
    raw, target = ([sum(column) for column in zip(*of)] for of in (counts.raw, counts.target))
    ratios = []
    for own_raw, own_target in zip(counts.raw, counts.target):
        ratios += _log_ratios([a - b for a, b in zip(raw, own_raw)], [a - b for a, b in zip(target, own_target)], smoothing)
    return ratios


def _literal(values: list[float]) -> Column:
    """A constant array; the optimizer folds it once."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _total(ratios: list[float], folds: int) -> Column:
    """Sum of the log ratios of a document's words and pairs."""
    buckets = len(ratios) // folds
    start = F.col("_fold") * buckets
    ratio = lambda hashed: F.get(_literal(ratios), start + _bucket(hashed, buckets.bit_length() - 1))
    return F.aggregate(F.zip_with("_single", "_pairs", lambda a, b: ratio(a) + ratio(b)), F.lit(0.0), lambda s, x: s + x)


def score_rules(
    docs: DataFrame, id_col: str, text_col: str, ratios: list[float], threshold: float = THRESHOLD, carry: list[Column] | None = None, folds: int = 1
) -> DataFrame:
    """Counts, base rule, score and verdict per row of `docs`, with the columns in `carry` added.

    `ratios` has a log ratio per bucket for each of `folds` folds, one after the other; a row's fold goes by its id.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), fold_of(F.col(id_col), folds).alias("_fold"), *(carry or []))
    carried = [c for c in rows.columns if c not in ("_id", "_text", "_fold")]
    rows = rows.withColumn("_words", words_of(F.col("_text"))).withColumn("_lines", lines)
    rows = _with_repeats(_with_hashes(rows))
    n_words, n_repeats = F.size("_words").cast("long"), F.col("_repeats")
    total = _total(ratios, folds)
    result = rows.select(
        F.col("_id").alias("doc_id"),
        n_words.alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(_replaced(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        n_repeats.alias("n_repeat_words"),
        ((n_words < MIN_WORDS) | (n_repeats * 100 > n_words * MAX_REPEAT_PERCENT)).alias("base_failed"),
        F.when(n_words > 0, total / (n_words * 2)).otherwise(0.0).alias("log_ratio"),
        *carried,
    )
    return result.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids that the labels mark as good; the trusted target."""
    return labels.filter(F.col("quality") == 1).select("doc_id")


def bad_documents(labels: DataFrame) -> DataFrame:
    """Ids that the labels mark as bad; the threshold parts them from the trusted ones."""
    return labels.filter(F.col("quality") == 0).select("doc_id")


def parting_threshold(good: dict[int, int], bad: dict[int, int]) -> float:
    """The cut, in steps of 1 / STEPS, with the least sum of the shares of good below and of bad from there on.

    Keys are scores in whole steps. Of equally good cuts it is the middle of the first widest run.
    """
    if not good or not bad:
        return THRESHOLD
    n_good, n_bad = sum(good.values()), sum(bad.values())
    low, high = min(*good, *bad), max(*good, *bad) + 1
    costs, below, above = [], 0, n_bad
    for cut in range(low, high + 1):  # good and bad of smaller keys lie below
        costs.append(below * n_bad + above * n_good)
        below, above = below + good.get(cut, 0), above - bad.get(cut, 0)
    least, best, start = min(costs), (0, 0), None
    for i, cost in enumerate([*costs, -1]):
        if cost == least and start is None:
            start = i
        elif cost != least and start is not None:
            best, start = max(best, (i - start, -start)), None
    return (low - best[1] + (best[0] - 1) // 2) / STEPS


def labelled_threshold(docs: DataFrame, id_col: str, text_col: str, ratios: list[float], trusted_ids: DataFrame, bad_ids: DataFrame) -> float:
    """Where the scores of all labelled rows part; a bounded number of counts reaches the driver."""
    rows = _with_labels(docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_body")), "_doc", trusted_ids, bad_ids, "inner")
    rows = rows.select("_row.*", "_trusted")
    scored = score_rules(rows, "_doc", "_body", ratios, carry=[F.col("_trusted")], folds=FOLDS)
    step = F.floor(F.least(F.greatest(F.col("log_ratio"), F.lit(-FARTHEST)), F.lit(FARTHEST)) * STEPS)
    found: tuple[dict, dict] = ({}, {})
    # No filter by the base rule, as it would be pushed down (see filter_quality): its failures are one group.
    for r in scored.groupBy("_trusted", F.when(~F.col("base_failed"), step).alias("step")).count().collect():
        if r["step"] is not None:
            found[r["_trusted"]][r["step"]] = r["count"]
    return parting_threshold(found[1], found[0])


def score_quality(docs: DataFrame, trusted_ids: DataFrame, bad_ids: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Counts, base rule, score and verdict of every row, each held against other folds; with `carry` the row as `_row`."""
    counts = bucket_counts(docs, id_col, text_col, trusted_ids)
    ratios = cross_ratios(counts)
    some = bad_ids is not None and any(map(any, counts.target))
    threshold = labelled_threshold(docs, id_col, text_col, ratios, trusted_ids, bad_ids) if some else THRESHOLD
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_body"), *([F.struct(*[F.col(c) for c in docs.columns]).alias("_row")] if carry else []))
    return score_rules(rows, "_doc", "_body", ratios, threshold, [F.col("_row")] if carry else None, FOLDS)


def filter_quality(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", bad_ids: DataFrame | None = None) -> DataFrame:
    """The rows of `docs` whose verdict is to keep, with all their columns."""
    scored = score_quality(docs, trusted_ids, bad_ids, id_col, text_col, carry=True)
    # Not a plain filter: that would be pushed down, with every column it stands on written out again and again.
    kept = scored.select(F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return kept.filter(F.col("_row").isNotNull()).select("_row.*")


def op8_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return score_quality(docs, trusted_documents(labels), bad_documents(labels))
