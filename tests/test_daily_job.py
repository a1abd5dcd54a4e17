"""The whole job from CSV files, twice."""

from __future__ import annotations

import shutil
from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import SF_DIR
from pyspark.sql import functions as F

from basketry.__main__ import main
from basketry.plans import daily_job
from basketry.plans.clusters import assign_clusters, cluster_features
from basketry.plans.daily_job import quality, reports, run_all, write_mart
from basketry.plans.registry import CENTERS, QUERIES
from basketry.plans.rfm import rfm_base
from basketry.schemas import SCHEMAS
from basketry.sources import sales_schema as sales
from basketry.sources.csv_files import export_csv
from basketry.sources.tables import publish, read_table


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    raw, out = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("out"))
    export_csv(sales.customers(spark, SF_DIR), f"{raw}/customers.csv")
    export_csv(sales.products(spark, SF_DIR), f"{raw}/products.csv")
    export_csv(sales.orders(spark, SF_DIR), f"{raw}/orders.csv")
    export_csv(sales.items_with_ids(spark, SF_DIR), f"{raw}/order_items.csv")
    return raw, out, run_all(spark, raw, out, sales.AS_OF)


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize(
    "table,query",
    [
        ("dim_customers", "dim_customers"),
        ("dim_date", "dim_date"),
        ("fact_orders", "fact_orders"),
        ("fact_order_items", "fact_order_items"),
        ("mart_customer_metrics", "customer_360"),
        ("mart_rfm_base", "rfm_base"),
        ("mart_rfm_scored", "rfm_scored"),
        ("mart_cohort_retention", "cohort_retention"),
    ],
)
def test_stored_tables_equal_the_queries(spark, job, table, query):
    assert same(read_table(spark, f"{job[1]}/tables", table), QUERIES[query](spark, SF_DIR))


def test_every_output_exists(spark, job):
    _, out, (root, exports) = job
    names = [
        "dq_report", "rfm_segments", "customer_clusters", "cluster_profiles", "cohort_retention",
        "revenue_by_segment", "retention_curve", "revenue_by_cluster",
    ]
    assert sorted(p.name for p in Path(exports).iterdir()) == sorted(names)
    for name in names:
        assert spark.read.option("header", True).csv(f"{exports}/{name}").count() > 0, name
    assert sorted(p.name for p in Path(root).iterdir()) == sorted(SCHEMAS)
    clusters = read_table(spark, f"{out}/tables", "mart_customer_clusters")
    assert clusters.count() == read_table(spark, f"{out}/tables", "dim_customers").count()


def test_second_run_changes_nothing(spark, job):
    raw, out, _ = job
    for arguments in (["load", "--truncate"], ["build", "--mode", "upsert"]):
        main([*arguments, "--data-dir", raw, "--out", out, "--as-of", sales.AS_OF])
    for table in ("dim_date", "fact_orders", "mart_customer_metrics", "mart_rfm_base"):
        query = "customer_360" if table == "mart_customer_metrics" else table.replace("mart_", "")
        assert same(read_table(spark, f"{out}/tables", table), QUERIES[query](spark, SF_DIR)), table


def test_full_quality_report(spark, job):
    report = {r.check: r.bad_rows for r in quality(spark, f"{job[1]}/tables").collect()}
    assert len(report) == 3 + 5 + 4 + 1 + 7 + 4
    assert all(bad == 0 for check, bad in report.items() if check.startswith(("unique_key", "foreign_key", "no_", "orders_have")))


def test_reports_without_input_are_skipped(spark, tmp_path):
    reports(spark, str(tmp_path / "tables"), str(tmp_path / "outputs"))
    assert [p.name for p in (tmp_path / "outputs").iterdir()] == ["revenue_by_segment"]


def test_upsert_mode_keeps_rows_that_left_the_window(spark, tmp_path):
    root = str(tmp_path)
    base = QUERIES["rfm_base"](spark, SF_DIR)
    write_mart(base, root, "mart_rfm_base")
    some = base.filter(F.col("customer_id") < 50).withColumn("recency_days", F.lit(-1))
    assert write_mart(some, root, "mart_rfm_base", "upsert").count() == base.count()
    assert write_mart(some, root, "mart_rfm_base").count() == some.count()
    with pytest.raises(ValueError):
        write_mart(some, root, "mart_rfm_base", "append")


def test_catalog_names(spark, job):
    publish(spark, f"{job[1]}/tables")
    done = spark.sql("SELECT count(*) FROM retail.v_orders_completed").first()[0]
    assert done == spark.sql("SELECT count(*) FROM retail.fact_orders WHERE status = 'completed'").first()[0] > 0
    assert spark.sql("SELECT * FROM retail.v_order_items_clean").columns == spark.table("retail.fact_order_items").columns
    assert same(spark.table("retail.v_order_items_clean"), QUERIES["items_clean"](spark, SF_DIR))


def test_date_filters_reach_the_stored_orders(spark, job):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    orders = read_table(spark, f"{job[1]}/tables", "fact_orders")
    plan = rfm_base(orders, sales.AS_OF, unique_orders=True)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(order_date,2000-08-01)" in pushed and "EqualTo(status,completed)" in pushed
    read = plan[plan.index("ReadSchema") :]
    assert "payment_type" not in read and "discount_total" not in read
    assert plan.count("Exchange hashpartitioning") == 1


def test_stored_orders_are_clustered_by_date(spark, job):
    files = [f.removeprefix("file://") for f in read_table(spark, f"{job[1]}/tables", "fact_orders").inputFiles()]
    spans = sorted(
        (pq.read_table(f, columns=["order_date"], partitioning=None)["order_date"].to_numpy() for f in files),
        key=lambda days: days[0],
    )
    assert all(list(days) == sorted(days) for days in spans)
    assert all(left[-1] <= right[0] for left, right in zip(spans, spans[1:]))


def test_a_failed_run_goes_on_where_it_stopped(spark, job, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    shutil.copytree(job[0], raw)
    monkeypatch.setattr(daily_job, "cluster_customers", lambda metrics: (assign_clusters(cluster_features(metrics), CENTERS), {}))
    ran = []
    for line in daily_job.STEPS:
        for step in line:
            def counted(s, root, exports, settings, own=step):
                ran.append(own.name)
                if own.name == "cohorts" and len(ran) < 9:
                    raise RuntimeError("no more memory")
                own.run(s, root, exports, settings)

            monkeypatch.setattr(daily_job, "STEPS", [[replace(x, run=counted) if x is step else x for x in y] for y in daily_job.STEPS])
    everything = [step.name for line in daily_job.STEPS for step in line]
    with pytest.raises(RuntimeError, match="no more memory"):
        run_all(spark, raw, out, sales.AS_OF)
    assert sorted(ran) == sorted(set(everything) - {"reports"})
    ran.clear()
    ran += ["-"] * 9
    run_all(spark, raw, out, sales.AS_OF)  # what failed and what follows it
    assert ran[9:] == ["cohorts", "reports"]
    run_all(spark, raw, out, sales.AS_OF)  # nothing is stale
    assert ran[9:] == ["cohorts", "reports"]
    ran[9:] = []
    run_all(spark, raw, out, "2001-09-01")  # another day: what depends on it
    assert sorted(ran[9:]) == ["clusters", "metrics", "reports", "rfm base", "scores"]
    ran[9:] = []
    # A new product: its dimension and what reads it.
    Path(f"{raw}/products.csv/part-more.csv").write_text("product_id,category,brand,unit_cost\n999999,Home,Nova,1.00\n")
    run_all(spark, raw, out, "2001-09-01")
    assert {"dims", "metrics", "quality"} <= set(ran[9:]) and not {"facts", "rfm base", "scores", "cohorts"} & set(ran[9:])
