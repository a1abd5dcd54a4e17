from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from basketry.functions.dates import age_month_field, full_months
from basketry.functions.segments import composite_score, segment_of
from basketry.operators.keyed_writes import insert_new, upsert
from basketry.operators.ranking import bin_edges, global_rank, quintile_of_rank, score_quintiles


def test_quintiles_match_qcut(spark):
    sizes = [*range(2, 60), 997, 1000, 1003]
    grid = spark.createDataFrame([(n, r) for n in sizes for r in range(1, n + 1)], "n long, r long")
    got = grid.withColumn("q", quintile_of_rank(F.col("r"), F.col("n"))).toPandas()
    for n, part in got.groupby("n"):
        want = pd.qcut(part["r"], 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert part["q"].tolist() == want.tolist(), n


def _expected_scores(df, metric):
    """Ranks from an ordinary global window, cut by pandas."""
    pdf = df.toPandas().sort_values([metric, "id"]).reset_index(drop=True)
    return dict(zip(pdf["id"], pd.qcut(pdf.index.to_series() + 1, 5, labels=[1, 2, 3, 4, 5]).astype(int)))


@pytest.mark.parametrize("n,slices,fetch_limit", [(2, 4, 1), (7, 4, 1), (613, 4, 1), (613, 16, 20), (5000, 1024, 100)])
def test_scores_match_ranks(spark, n, slices, fetch_limit):
    rng = random.Random(n)
    rows = [
        (
            i * 7 - 50,
            rng.choice([0, 0, 0, 1, 2, 9]),
            Decimal(rng.choice([1, 10, 10**6, 10**9])) * rng.randint(-50, 50) / 100,
            5,
            date(2024, 1, 1) + timedelta(days=rng.randint(0, 3)),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id int, few int, money decimal(14,2), same long, day date").cache()
    metrics = ["few", "money", "same", "day"]
    scored = score_quintiles(df, "id", {f"{m}_up": (m, True) for m in metrics} | {f"{m}_down": (m, False) for m in metrics}, slices, fetch_limit).collect()
    for metric in metrics:
        want = _expected_scores(df, metric)
        assert {r.id: r[f"{metric}_up"] for r in scored} == want, metric
        assert {r.id: r[f"{metric}_down"] for r in scored} == {i: 6 - q for i, q in want.items()}, metric


def test_scores_refuse_what_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="bin edges must be unique"):
        bin_edges(spark.createDataFrame([(1, 1)], "id int, v int"), "id", ["v"])
    with pytest.raises(ValueError, match="cannot rank NULL: v"):
        bin_edges(spark.createDataFrame([(1, 1), (2, None)], "id int, v int"), "id", ["v"])
    with pytest.raises(TypeError):
        bin_edges(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "id", ["v"])


def test_global_rank_matches_one_window(spark):
    df = spark.range(0, 20_000, 1, 7).selectExpr("id", "if(id % 3 = 0, 42, id * 7919 % 1000) as v")
    ranked = global_rank(df, ["v", "id"])
    want = df.withColumn("rank", F.row_number().over(Window.orderBy("v", "id")))
    assert ranked.exceptAll(want.withColumn("rank", F.col("rank").cast("long"))).count() == 0
    assert ranked.count() == 20_000


def test_global_rank_spreads_copies(spark):
    copies = spark.range(0, 9_000, 1, 3).select(F.lit(1).alias("v"))
    ranked = global_rank(copies, ["v"])
    assert ranked.select("rank").distinct().count() == 9_000
    assert ranked.agg(F.min("rank"), F.max("rank")).first() == (1, 9_000)
    assert global_rank(copies.limit(0), ["v"]).count() == 0


def test_segments(spark):
    scores = spark.range(125).selectExpr("cast(id div 25 + 1 as int) r", "cast(id div 5 % 5 + 1 as int) f", "cast(id % 5 + 1 as int) m")
    got = scores.select("r", "f", "m", segment_of(F.col("r"), F.col("f"), F.col("m")).alias("s"), composite_score(F.col("r"), F.col("f"), F.col("m")).alias("c")).collect()
    assert Counter(r.s for r in got) == {
        "Champions": 8, "Loyal": 10, "Big Spenders": 18, "New": 12, "At Risk": 42, "Hibernating": 8, "Needs Attention": 27,
    }
    assert all(r.c == int(f"{r.r}{r.f}{r.m}") for r in got)


def test_month_arithmetic_matches_age(spark):
    rng = random.Random(5)
    start = date(2019, 12, 25)
    days = [start + timedelta(days=rng.randint(0, 1500)) for _ in range(1200)] + [date(2023, 1, 31), date(2024, 2, 29), date(2023, 2, 28)]
    pairs = [tuple(sorted((rng.choice(days), rng.choice(days)))) for _ in range(3000)] + [(date(2023, 1, 31), date(2023, 2, 28))]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", age_month_field(F.col("b"), F.col("a")).alias("m"), full_months(F.col("b"), F.col("a")).alias("t")).toPandas()
    con = duckdb.connect()
    con.register("got", got)
    wrong = con.execute(
        """SELECT count(*) FROM (SELECT *, age(b::date::timestamp, a::date::timestamp) AS s FROM got)
           WHERE m <> extract(month FROM s) OR t <> 12 * extract(year FROM s) + extract(month FROM s)"""
    ).fetchone()[0]
    assert wrong == 0


@pytest.fixture
def letters(spark):
    return lambda *rows: spark.createDataFrame(rows, "id int, v string")


def test_upsert(letters):
    target, batch = letters((1, "a"), (2, "b")), letters((2, "c"), (3, "d"))
    once = upsert(target, batch, ["id"])
    assert sorted(once.collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(upsert(once, batch, ["id"]).collect()) == sorted(once.collect())
    assert sorted(upsert(target.limit(0), batch, ["id"]).collect()) == [(2, "c"), (3, "d")]


def test_upsert_takes_null_values_and_any_column_order(letters):
    batch = letters((2, None)).select("v", "id")
    assert sorted(upsert(letters((1, "a"), (2, "b")), batch, ["id"]).collect()) == [(1, "a"), (2, None)]


@pytest.mark.parametrize("bad", [[(2, "c"), (2, "d")], [(None, "c")]])
def test_upsert_refuses_ambiguous_batches(letters, bad):
    with pytest.raises(Exception, match="NULL or not unique"):
        upsert(letters((1, "a")), letters(*bad), ["id"]).collect()


def test_insert_new(letters):
    target = letters((1, "a"), (2, "b"))
    assert sorted(insert_new(target, letters((2, "c"), (3, "e"), (3, "d")), ["id"]).collect()) == [(1, "a"), (2, "b"), (3, "d")]
    ids = target.select("id")
    assert sorted(insert_new(ids, letters((3, "x"), (3, "y")).select("id"), ["id"]).collect()) == [(1,), (2,), (3,)]


def test_repeated_ids_stop_the_score_search(spark):
    rows = spark.range(60_000).selectExpr("1 AS id", "cast(5 AS int) AS v")
    with pytest.raises(ValueError, match="id 1 occurs"):
        score_quintiles(rows, "id", {"score": ("v", True)})


def test_segments_of_missing_scores(spark):
    rows = spark.createDataFrame([(5, None, 5), (None, None, None), (2, 3, None)], "r int, f int, m int")
    assert [x[0] for x in rows.select(segment_of(F.col("r"), F.col("f"), F.col("m"))).collect()] == ["Big Spenders", "Needs Attention", "At Risk"]
