"""The whole job, in dependency order. Every step reads stored tables and can run on its own."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.keyed_writes import upsert
from ..operators.quality import (
    ACCEPTED,
    check_rows,
    dq_accepted_values,
    dq_foreign_keys,
    dq_reconcile,
    dq_report,
    dq_unique_keys,
    order_rollup,
)
from ..schemas import KEYS, REFERENCES, SCHEMAS
from ..sources.csv_files import export_csv
from ..sources.staging import drop_staged, stage
from ..sources.tables import read_table, replace_table, table_version
from ..sources.versions import names_in, read_text, write_new
from . import bronze
from .clusters import cluster_customers, cluster_profile
from .cohorts import cohort_retention
from .customer360 import customer_360
from .reports import report_clusters, report_retention_curve, report_segments
from .rfm import rfm_base, rfm_segments


def write_mart(df: DataFrame, root: str, table: str, mode: str = "snapshot") -> DataFrame:
    """Store a mart and return it as stored.

    snapshot: the rows of this run. upsert: rows of earlier runs stay unless this run has their key.
    """
    if mode not in ("snapshot", "upsert"):
        raise ValueError(f"mode must be snapshot or upsert, not {mode}")
    if mode == "upsert":
        df = upsert(read_table(df.sparkSession, root, table), df, KEYS[table])
    replace_table(df, root, table)
    return read_table(df.sparkSession, root, table)


def quality(spark: SparkSession, root: str, full: bool = True) -> DataFrame:
    """The three standing checks, and with `full` also keys, references, dates, values and amounts.

    The full report shuffles the items by order once: orphans, references and amounts share the result.
    """
    tables = {name: read_table(spark, root, name) for name in SCHEMAS if name.startswith(("dim_", "fact_"))}
    orders, items = tables["fact_orders"], tables["fact_order_items"]
    if not full:
        return dq_report(orders, items)
    rollup = stage(order_rollup(items))
    parts = [
        dq_report(orders, items, rollup),
        dq_unique_keys(tables, KEYS),
        dq_foreign_keys(tables, REFERENCES, {("fact_order_items", "order_id"): rollup}),
        check_rows(read_table(spark, root, "raw_orders"), {"orders_have_a_date": F.count_if(F.col("order_date").isNull())}),
        dq_accepted_values(tables, ACCEPTED),
        dq_reconcile(orders, rollup),
    ]
    return reduce(DataFrame.unionByName, parts)


def build_metrics(spark: SparkSession, root: str, as_of: date | str | None = None, mode: str = "snapshot") -> None:
    customers, products = read_table(spark, root, "dim_customers"), read_table(spark, root, "dim_products")
    orders, items = read_table(spark, root, "fact_orders"), read_table(spark, root, "fact_order_items")
    write_mart(customer_360(customers, products, orders, items, as_of), root, "mart_customer_metrics", mode)


def build_rfm_base(spark: SparkSession, root: str, as_of: date | str | None = None, mode: str = "snapshot") -> None:
    write_mart(rfm_base(read_table(spark, root, "fact_orders"), as_of, unique_orders=True), root, "mart_rfm_base", mode)


def build_marts(spark: SparkSession, root: str, as_of: date | str | None = None, mode: str = "snapshot") -> None:
    """Dimensions, facts, customer metrics and RFM base from the raw tables."""
    bronze.build_dims(spark, root)
    bronze.build_facts(spark, root)
    build_metrics(spark, root, as_of, mode)
    build_rfm_base(spark, root, as_of, mode)


def score_customers(spark: SparkSession, root: str, exports: str) -> None:
    segments = rfm_segments(read_table(spark, root, "mart_rfm_base"))
    export_csv(segments, f"{exports}/rfm_segments")
    write_mart(segments, root, "mart_rfm_scored")


def group_customers(spark: SparkSession, root: str, exports: str) -> None:
    clusters, _ = cluster_customers(read_table(spark, root, "mart_customer_metrics"))
    clusters = write_mart(clusters, root, "mart_customer_clusters")
    export_csv(clusters.select(*[c for c in clusters.columns if c != "cluster_id"], "cluster_id"), f"{exports}/customer_clusters")
    export_csv(cluster_profile(clusters), f"{exports}/cluster_profiles")


def follow_cohorts(spark: SparkSession, root: str, exports: str) -> None:
    retention = write_mart(cohort_retention(read_table(spark, root, "fact_orders")), root, "mart_cohort_retention")
    export_csv(retention, f"{exports}/cohort_retention")


def reports(spark: SparkSession, root: str, exports: str) -> None:
    """The tables behind the charts; a report without input is skipped."""
    base, scored = read_table(spark, root, "mart_rfm_base"), read_table(spark, root, "mart_rfm_scored")
    retention, clusters = read_table(spark, root, "mart_cohort_retention"), read_table(spark, root, "mart_customer_clusters")
    export_csv(report_segments(scored, base), f"{exports}/revenue_by_segment")
    if not retention.isEmpty():
        export_csv(report_retention_curve(retention), f"{exports}/retention_curve")
    if not clusters.isEmpty():
        export_csv(report_clusters(clusters), f"{exports}/revenue_by_cluster")


@dataclass(frozen=True)
class Step:
    """A part of the job: the tables it reads and writes, and the exports it leaves."""

    name: str
    run: Callable[[SparkSession, str, str, dict], object]
    reads: tuple[str, ...]
    writes: tuple[str, ...] = ()
    exports: tuple[str, ...] = ()
    settings: tuple[str, ...] = ()  # names of run-time settings its result depends on


_RAW, _DIMS = ("raw_customers", "raw_products", "raw_orders", "raw_order_items"), ("dim_customers", "dim_products", "dim_date")
_FACTS = ("fact_orders", "fact_order_items")

# Steps in one line run at the same time: their jobs share the cluster.
STEPS: list[list[Step]] = [
    [
        Step("dims", lambda s, root, _, __: bronze.build_dims(s, root), _RAW[:3], _DIMS),
        Step("facts", lambda s, root, _, __: bronze.build_facts(s, root), _RAW[2:], _FACTS),
    ],
    [
        Step("metrics", lambda s, root, _, o: build_metrics(s, root, **o), _DIMS[:2] + _FACTS, ("mart_customer_metrics",), (), ("as_of", "mode")),
        Step("rfm base", lambda s, root, _, o: build_rfm_base(s, root, **o), _FACTS[:1], ("mart_rfm_base",), (), ("as_of", "mode")),
        Step("quality", lambda s, root, out, _: export_csv(quality(s, root), f"{out}/dq_report"), _DIMS + _FACTS + ("raw_orders",), (), ("dq_report",)),
    ],
    [
        Step("scores", lambda s, root, out, _: score_customers(s, root, out), ("mart_rfm_base",), ("mart_rfm_scored",), ("rfm_segments",)),
        Step("clusters", lambda s, root, out, _: group_customers(s, root, out), ("mart_customer_metrics",), ("mart_customer_clusters",), ("customer_clusters", "cluster_profiles")),
        Step("cohorts", lambda s, root, out, _: follow_cohorts(s, root, out), _FACTS[:1], ("mart_cohort_retention",), ("cohort_retention",)),
    ],
    [Step("reports", lambda s, root, out, _: reports(s, root, out), ("mart_rfm_base", "mart_rfm_scored", "mart_cohort_retention", "mart_customer_clusters"))],
]


def _numbers(spark: SparkSession, root: str, tables: tuple[str, ...]) -> dict[str, int]:
    return {t: (v.number if (v := table_version(spark, root, t)) else 0) for t in tables}


def _run_step(spark: SparkSession, step: Step, root: str, exports: str, ledger: str, settings: dict[str, str]) -> bool:
    """Run a step unless the ledger says that it ran on the same versions and settings and its results are still there."""
    path = f"{ledger}/{step.name.replace(' ', '_')}.json"
    due = {"reads": _numbers(spark, root, step.reads), "settings": {k: settings[k] for k in step.settings}}
    try:
        done = json.loads(read_text(spark, path) or "{}")
    except ValueError:  # cut short while it was written
        done = {}
    there = set(names_in(spark, exports)).issuperset(step.exports)
    if there and done == {**due, "writes": _numbers(spark, root, step.writes)}:
        return False
    step.run(spark, root, exports, due["settings"])
    write_new(spark, path, json.dumps({**due, "writes": _numbers(spark, root, step.writes)}), overwrite=True)
    return True


def run_all(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    as_of: date | str | None = None,
    mode: str = "snapshot",
    truncate: bool = True,
    tidy: bool = True,
) -> tuple[str, str]:
    """CSV files to tables, marts, exports and reports; returns the folders of tables and of exports.

    A ledger keeps, for every step, the versions of the tables it read and wrote. A run does only what is stale:
    after a failure it goes on at the first step that is not done, after a change of some files with what depends on
    them, and without any change it does nothing. The date defaults to today's, so the next day's run is due.
    """
    root, exports, ledger = f"{out_dir}/tables", f"{out_dir}/outputs", f"{out_dir}/ledger"
    settings = {"as_of": str(as_of or spark.sql("SELECT current_date()").first()[0]), "mode": mode}
    try:
        bronze.load_raw(spark, in_dir, root, truncate=truncate)
        for together in STEPS:
            with ThreadPoolExecutor(len(together)) as pool:
                run = inheritable_thread_target(spark)(lambda step: _run_step(spark, step, root, exports, ledger, settings))
                list(pool.map(run, together))
    finally:
        if tidy:  # what this application staged
            drop_staged(spark)
    return root, exports
