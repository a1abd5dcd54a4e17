from __future__ import annotations

import math
import random
import re
from collections import Counter

import brute
import duckdb
import pandas as pd
import pytest
import xxhash

import __spark_entry__
import corpus_pipeline
from basketry.llm import quality_rules
from basketry.llm.registry import ORACLES, QUERIES
from basketry.schemas import conform  # noqa: F401  the rest of the library stays importable beside this part

SF_DIR = "/root/testdata/sf0.001"


def hashes(text):
    words = brute.WORD.findall(text or "")
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    two = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(one, words[1:])] + one[-1:]
    return [h >> 64 - quality_rules.BUCKET_BITS for h in one + two]


def fold_of(i):
    h = xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42)
    return (h - (h >> 63 << 64)) % quality_rules.FOLDS


def kept_by_quality(docs, labels):
    """Ids that pass: ratios from the other folds, threshold where labelled good and bad scores part."""
    label = dict(zip(labels.doc_id, labels.quality))
    raw, target = ([Counter() for _ in range(quality_rules.FOLDS)] for _ in range(2))
    for i, text in zip(docs.doc_id, docs.text):
        raw[fold_of(i)].update(hashes(text))
        target[fold_of(i)].update(hashes(text) if label.get(i) == 1 else [])
    scores, size = {}, 1 << quality_rules.BUCKET_BITS
    for i, text in zip(docs.doc_id, docs.text):
        r, t = (sum((c for f, c in enumerate(of) if f != fold_of(i)), Counter()) for of in (raw, target))
        ratio = lambda h: math.log((t[h] + 1) / (t.total() + size)) - math.log((r[h] + 1) / (r.total() + size))  # noqa: E731, B023
        found = hashes(text)
        scores[i] = sum(map(ratio, found)) / max(1, len(found))
    passing = {i for i, text in zip(docs.doc_id, docs.text) if not brute.rules(text)[-1]}
    steps = lambda q: Counter(math.floor(scores[i] * quality_rules.STEPS) for i in passing if label.get(i) == q)
    threshold = quality_rules.parting_threshold(steps(1), steps(0))
    assert threshold != quality_rules.THRESHOLD
    return {i for i in passing if scores[i] >= threshold}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(30)]
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    good = [prose(draw.randint(60, 200)) + "\n" + prose(30) for _ in range(60)]
    items = [prose(30) for _ in range(4)]
    texts = good + [good[0], good[1] + " end", good[2].upper()]  # copies, near and by case
    texts += [" ".join(w + "%%%" for w in prose(90).split()) for _ in range(12)]  # junk
    texts += [prose(80) + " " + items[0] + " " + prose(20), items[1].upper() + "\n" + prose(70)]  # passages of the benchmark
    texts += [prose(20), "", None]  # too short
    texts = [t + "\nread more on this site" if t and i % 3 == 0 and len(t) > 300 else t for i, t in enumerate(texts)]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": [f"s{i % 2}" for i in range(len(texts))]})
    docs["n_chars"] = docs.text.map(lambda t: len(t or ""))
    labels = pd.DataFrame({"doc_id": range(len(texts))})
    labels["quality"] = [int("%%%" not in (texts[i] or "")) for i in labels.doc_id]
    labels["toxic"] = 0
    path = tmp_path_factory.mktemp("corpus")
    docs.to_parquet(path / "documents.parquet")
    labels.astype({"quality": "int32", "toxic": "int32"}).to_parquet(path / "labels.parquet")
    pd.DataFrame({"item_id": range(4), "text": items}).to_parquet(path / "benchmark.parquet")
    return path, docs, labels, items


def test_pipeline_against_plain_python(spark, folder):
    path, docs, labels, items = folder
    kept = kept_by_quality(docs, labels)
    rows = [(i, s, t) for i, s, t in zip(docs.doc_id, docs.source, docs.text) if i in kept]
    assert 60 <= len(rows) <= 66
    rows = [(i, s, t) for (i, s, _), t in zip(rows, brute.without_boilerplate([(s, t) for _, s, t in rows]))]
    assert not any("read more" in t for *_, t in rows)
    least = brute.components([(i, brute.fingerprint(t)) for i, _, t in rows])
    rows = [r for r, c in zip(rows, least) if r[0] == c]
    rows = [r for r in rows if not brute.contamination(r[2], list(enumerate(items)))[1]]
    assert 55 <= len(rows) <= 61

    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(path)).collect()}
    assert sorted(got) == [i for i, *_ in rows]
    # On a host this small the lines of two copies are boilerplate, so a text may be left empty.
    assert all(got[i].decoded_sha256 == brute.sha(t) and (got[i].n_tokens > 0) == bool(t) for i, _, t in rows)


def test_stages_return_the_columns_of_documents(spark, folder):
    path = str(folder[0])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).schema.names == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0


def test_every_operator_has_one_query():
    names = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(names) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for name_of in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{SF_DIR}/{name_of}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == sorted(repr(tuple(r)) for r in result.fetchall())
