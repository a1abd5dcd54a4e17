"""A document is held against the counts of other folds, and unlabelled documents fare like labelled ones at every size."""

from __future__ import annotations

import math
import random
from collections import Counter

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm import quality_rules


def buckets(text, bits):
    words = brute.WORD.findall(text or "")
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    two = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(one, words[1:])] + one[-1:]
    return Counter(h >> 64 - bits for h in one + two)


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_scores_come_from_the_other_folds(spark, monkeypatch, broadcast):
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", broadcast)
    draw = random.Random(2)
    words = ["".join(draw.choice("abcd") for _ in range(3)) for _ in range(40)]
    texts = [None, "", "a", "a a a a", *[" ".join(draw.choice(words) for _ in range(draw.randint(1, 120))) for _ in range(30)]]
    texts += [" ".join(draw.choice(words) for _ in range(30_000))]  # a very long one
    ids = [*range(len(texts) - 2), None, None]
    trusted, bits = {3, 5, 8, 13, 21}, 6
    df = spark.createDataFrame(list(zip(ids, range(len(texts)), texts)), "doc_id long, n long, text string")
    trusted_ids = spark.createDataFrame([(i,) for i in [*trusted, None]], "id long")
    counts = quality_rules.bucket_counts(df, "doc_id", "text", trusted_ids, bits=bits)
    got = quality_rules.score_rules(df, "doc_id", "text", quality_rules.cross_ratios(counts), carry=[F.col("n")], folds=quality_rules.FOLDS)
    fold = {r.n: r.f for r in df.select("n", quality_rules.fold_of(F.col("doc_id"), quality_rules.FOLDS).alias("f")).collect()}
    assert set(fold.values()) == set(range(quality_rules.FOLDS))
    own = [buckets(t, bits) for t in texts]
    for r in got.collect():
        raw, target = Counter(), Counter()
        for j, c in enumerate(own):
            if fold[j] != fold[r.n]:
                raw += c
                target += c if ids[j] in trusted else Counter()
        total = lambda c: sum(c.values()) + (1 << bits)
        ratio = lambda b: math.log((target[b] + 1) / total(target)) - math.log((raw[b] + 1) / total(raw))  # noqa: E731, B023
        n = sum(own[r.n].values())
        want = sum(c * ratio(b) for b, c in own[r.n].items()) / max(n, 1) if target else 0.0
        assert r.log_ratio == pytest.approx(want, abs=2e-6)
        assert r.n_words == len(brute.WORD.findall(texts[r.n] or ""))


def test_threshold_parts_good_from_bad():
    assert quality_rules.parting_threshold({}, {3: 1}) == quality_rules.parting_threshold({3: 1}, {}) == quality_rules.THRESHOLD
    cut = quality_rules.parting_threshold({0: 5, 10: 5}, {-100: 2, -20: 1}) * quality_rules.STEPS
    assert -20 < cut <= 0 and cut == pytest.approx(-10, abs=1)
    assert quality_rules.parting_threshold({0: 1, 5: 99}, {-9: 1, 4: 99}) * quality_rules.STEPS == 5


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_unlabelled_documents_fare_like_labelled_ones(spark, size):
    folder = f"/root/testdata/{size}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    found = quality_rules.op8_quality_rules(spark, folder).join(labels, "doc_id", "left").groupBy("quality")
    found = found.agg(F.count_if(~F.col("base_failed")).alias("n"), F.count_if(~F.col("base_failed") & ~F.col("kept")).alias("lost"))
    n, lost = ({r.quality: r[k] for r in found.collect()} for k in ("n", "lost"))
    print(size, n, lost)
    assert lost[None] / n[None] <= (lost[0] + lost[1]) / (n[0] + n[1]) + 0.03
    assert lost[1] <= 0.02 * n[1] and lost[0] >= 0.6 * n[0]
