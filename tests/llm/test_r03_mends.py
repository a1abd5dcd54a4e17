"""Cases that went wrong before: rows that vanished, caps, classes that workers could not open."""

from __future__ import annotations

import os
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hot_join, line_dedup, quality_classifier, simhash, token_sums

REPO = Path(__file__).resolve().parents[2]


def test_an_id_on_two_texts_loses_no_component(spark):
    a, b, c = ("alpha beta gamma delta one two three", "red green blue white black pink grey", "so it goes on and on without end")
    docs = spark.createDataFrame([(1, b), (2, a), (5, a), (2, b), (7, c), (7, c), (None, a), (None, a)], "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(1, b), (2, a), (7, c), (None, a), (None, a)], key=repr)


def test_lines_on_two_pages_are_boilerplate_of_a_small_host(spark):
    docs = spark.createDataFrame([(i, "h", f"own {i}\nfoot") for i in range(3)] + [(9, "g", "foot\nown")], "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(docs).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 9: "foot\nown"}


def test_hot_and_missing_keys_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id")
        table = spark.createDataFrame([("hot", 1), ("1", 2), ("nobody", 3)], "k string, v int")
        joined = hot_join.join_spread(rows, table, "k")
        assert hot_join.hot_keys(rows, "k") == ["hot"]
        found = {r.v: r.n for r in joined.groupBy("v").agg(F.count("*").alias("n")).collect()}
        assert found == {1: 3000, 2: 1, None: 5999} and joined.select("id").distinct().count() == 9000
        most = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 2 * 9000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_colliding_token_keys_are_hashed_anew(spark, monkeypatch):
    real, salts = F.xxhash64, []

    def colliding(column):
        salts.append(1)
        return F.lit(7).cast("long") if len(salts) == 1 else real(column)

    monkeypatch.setattr(token_sums.F, "xxhash64", colliding)
    table, salt = token_sums.keyed(spark.createDataFrame([("a", 1, 5), ("b", 2, 5)], "token string, value long, n long"))
    assert salt == "+" and table.select("key").distinct().count() == 2


def test_training_sees_every_chunk(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda documents, labels: seen.extend(zip(documents, labels)) or 0.5)
    texts = {i: f"{i} " * (1 + 997 * i) for i in range(40)}
    docs, labels = (spark.createDataFrame(rows, kind) for rows, kind in (([*texts.items()], "doc_id long, text string"), ([(i, i % 2) for i in texts], "doc_id long, quality int")))
    quality_classifier.train(docs, labels)
    trained = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    want = sorted((i % 2, quality_classifier.chunks_of(texts[i]).tobytes()) for i in trained)
    assert sorted((q, c.tobytes()) for c, q in seen) == want and max(len(c) for c, _ in seen) > 500


def test_score_is_the_forward_pass():
    rng = np.random.default_rng(1)
    width, filters = quality_classifier.WIDTH, quality_classifier.FILTERS
    net = {
        "filters": rng.normal(size=(width, 256, filters)).astype(np.float32), "shift": rng.normal(size=filters).astype(np.float32),
        "weights": rng.normal(size=2 * filters).astype(np.float32), "bias": np.array([0.3], np.float32),
    }
    for text in (None, "", "abc", "é" * 300, "some words " * 100):
        raw = (text or "").encode()
        pooled = []
        for at in range(0, max(1, len(raw) - 64), 192):
            chunk = raw[at : at + 256].ljust(256, b"\0")
            best = [max(sum(float(net["filters"][j][chunk[i + j]][f]) for j in range(width)) for i in range(256 - width + 1)) for f in range(filters)]
            pooled.append([max(0.0, b + float(net["shift"][f])) for f, b in enumerate(best)])
        mean, most = np.mean(pooled, axis=0), np.max(pooled, axis=0)
        want = 1 / (1 + np.exp(-np.clip(np.concatenate([mean, most]) @ net["weights"] + 0.3, -40, 40)))
        assert quality_classifier.score_text(net, text) == pytest.approx(want, abs=1e-4)


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path only: workers start without it
from basketry.session import build_session
from basketry.llm.registry import QUERIES
spark = build_session("local-cluster[1,4,3000]", "away", {{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
    "spark.checkpoint.dir": {shared!r}, "spark.sql.warehouse.dir": {shared!r}, "spark.executor.memory": "2000m"}})
for name, query in QUERIES.items():
    print("ran", name, query(spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_workers_do_not_need_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env |= {"PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_DIRS": str(tmp_path / "local")}
    script = tmp_path / "away.py"
    script.write_text(WITHOUT_PACKAGE.format(repo=str(REPO), shared=str(tmp_path / "shared")))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and done.stdout.count("ran op") == 13, done.stdout[-500:] + done.stderr[-2000:]
