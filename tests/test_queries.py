"""Every registered query against DuckDB, and the shape of the plans."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from helpers import SF_DIR

from basketry.plans.oracles import ORACLES
from basketry.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    assert ours == sorted(repr(tuple(r)) for r in result.fetchall())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["customer_360", "rfm_scored", "cohort_retention", "rfm_ranks", "dq_foreign_keys", "upsert_orders"])
def test_plans_without_broadcast_have_no_cross_join_or_single_sort(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    assert "Python" not in plan
    if not name.startswith("dq_"):  # checks end in one global count each
        assert "SinglePartition" not in plan


def test_unused_discounts_cost_nothing(spark):
    assert "l_discount" not in plan_of(QUERIES["customer_360"](spark, SF_DIR))
    assert "lineitem" not in plan_of(QUERIES["rfm_base"](spark, SF_DIR))
