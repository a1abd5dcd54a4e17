"""Every operator and job as a query over a folder of sales tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import as_of_column
from ..operators.clustering import best_k, choose_k, lloyd_step, nearest_center, score_centers, standardize
from ..operators.keyed_writes import insert_new, upsert
from ..operators.quality import (
    dq_accepted_values,
    dq_foreign_keys,
    dq_reconcile,
    dq_report,
    dq_unique_keys,
    order_rollup,
)
from ..operators.ranking import global_rank, quintile_of_rank
from ..schemas import KEYS, REFERENCES
from ..sources import sales_schema as sales
from ..sources.csv_files import RAW_FILES, export_csv, read_raw
from ..sources.staging import shared_dir, stage
from ..sources.tables import append_table, drop_table, preview, publish, read_table, replace_table
from . import bronze, customer360 as c360, rfm, silver
from .clusters import COLUMNS, assign_clusters, cluster_customers, cluster_features, cluster_profile
from .cohorts import cohort_retention, first_purchase
from .daily_job import run_all
from .reports import report_clusters, report_retention_curve, report_segments

Query = Callable[[SparkSession, str], DataFrame]

RELOAD_FROM, LOADED_UNTIL = "1999-01-01", "2000-01-01"
RELOAD_SHIPPING = "5.00"
EARLIER_AS_OF = "2001-02-01"
NO_ORDERS_AS_OF = "2003-01-01"

# Centres in standardised units, in the order of COLUMNS, for the queries that do not fit.
CENTERS = [
    [-1.0, -1.0, -0.5, -0.5, -0.5, 1.0, 0.0],
    [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.0, 1.0, 0.5, 0.0, 0.5, -0.5, -0.5],
    [0.0, -0.5, 0.0, 0.5, 0.0, 0.0, 1.0],
]

LLOYD_STEPS = 3

# For every k, centres spread evenly along the diagonal.
CENTER_SETS = {k: [[-1.0 + 2.0 * i / (k - 1)] * len(COLUMNS) for i in range(k)] for k in range(3, 9)}


def _date_rows(spark: SparkSession, d: str) -> DataFrame:
    return bronze.date_rows(sales.orders(spark, d))


def _repeated(rows: DataFrame, key: str, every: int) -> DataFrame:
    """Every so many keys twice."""
    return rows.unionByName(rows.filter(F.col(key) % every == 0))


def _faulty_customers(spark: SparkSession, d: str) -> DataFrame:
    """Some customers twice, some without id, some with accepted names."""
    key = F.col("customer_id")
    rows = _repeated(sales.customers(spark, d), "customer_id", 50)
    rows = rows.withColumn("country", F.when(key % 3 == 0, "US").otherwise(F.col("country")))
    rows = rows.withColumn("channel", F.when(key % 5 == 0, "web").otherwise(F.col("channel")))
    rows = rows.withColumn("email_domain", F.when(key % 7 == 0, "proton.me").otherwise(F.col("email_domain")))
    return rows.withColumn("customer_id", F.when(key % 61 != 0, key))


def _faulty_products(spark: SparkSession, d: str) -> DataFrame:
    """Some products twice, some missing, some with accepted names."""
    key = F.col("product_id")
    rows = _repeated(sales.products(spark, d), "product_id", 40).filter(key % 71 != 0)
    rows = rows.withColumn("category", F.when(key % 2 == 0, "Home").otherwise(F.col("category")))
    return rows.withColumn("brand", F.when(key % 3 == 0, "Nova").otherwise(F.col("brand")))


def _faulty_orders(spark: SparkSession, d: str) -> DataFrame:
    """Some orders twice, some missing, some without id; some totals negative or zero, some states and payments odd."""
    key = F.col("order_id")
    rows = _repeated(sales.orders(spark, d), "order_id", 90).filter(key % 89 != 0)
    money = {"order_total": F.col("order_total"), "discount_total": F.col("discount_total")}
    for name, amount in money.items():
        changed = F.when((F.col("status") == "cancelled") & (key % 2 == 0), 0).when(key % 83 == 0, -amount).otherwise(amount)
        rows = rows.withColumn(f"_{name}", changed.cast("decimal(12,2)"))
    rows = rows.drop(*money).withColumnsRenamed({f"_{name}": name for name in money})
    rows = rows.withColumn("payment_type", F.when(key % 4 == 0, "card").otherwise(F.col("payment_type")))
    rows = rows.withColumn("status", F.when(key % 67 == 0, "lost").otherwise(F.col("status")))
    return rows.withColumn("order_id", F.when(key % 97 != 0, key)).select(*sales.orders(spark, d).columns)


def _faulty_items(spark: SparkSession, d: str, item_ids: bool = False) -> DataFrame:
    """Some items without quantity, some twice, some without id; some lines of zero."""
    rows = (sales.items_with_ids if item_ids else sales.items)(spark, d)
    key = F.col("product_id")
    rows = rows.withColumn("quantity", F.when(key % 79 == 0, 0).otherwise(F.col("quantity")))
    rows = rows.withColumn("line_total", F.when(key % 5 == 0, F.lit(0).cast("decimal(12,2)")).otherwise(F.col("line_total")))
    if item_ids:
        number = F.col("order_item_id")
        rows = _repeated(rows, "order_item_id", 100).withColumn("order_item_id", F.when(number % 101 != 0, number))
    return rows


def _tables(spark: SparkSession, d: str, item_ids: bool = False) -> dict[str, DataFrame]:
    """Tables with planted faults: every check has something to find."""
    return {
        "dim_customers": _faulty_customers(spark, d),
        "dim_products": _faulty_products(spark, d),
        "dim_date": _date_rows(spark, d).filter(F.dayofmonth("date_key") != 13),
        "fact_orders": _faulty_orders(spark, d),
        "fact_order_items": _faulty_items(spark, d, item_ids),
    }


def _through_csv(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """Rows written as the CSV input of `table` and read back."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    file = next(f for f, t in RAW_FILES.items() if t == table)
    export_csv(rows, f"{folder}/{file}")
    return read_raw(spark, folder, table)


def _stored_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders loaded up to one day and stored as facts, which a batch then corrects and extends."""
    root = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    target, batch = _two_loads(spark, d)
    append_table(target, root, "raw_orders")
    replace_table(read_table(spark, root, "raw_orders"), root, "fact_orders")
    replace_table(batch, root, "raw_orders")
    bronze.upsert_table(read_table(spark, root, "raw_orders"), root, "fact_orders")
    return read_table(spark, root, "fact_orders")


def _stored_marts(spark: SparkSession, d: str) -> DataFrame:
    """The metrics mart as stored, after an earlier day's version and one whose job fails while it is written."""
    root = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    replace_table(_metrics_as_of(spark, d, EARLIER_AS_OF), root, "mart_customer_metrics")
    now = stage(_metrics(spark, d))
    replace_table(now, root, "mart_customer_metrics")
    broken = now.withColumn("total_orders", F.raise_error(F.lit("a fault on purpose")).cast("int"))
    try:
        replace_table(broken, root, "mart_customer_metrics")
    except Exception as fault:  # noqa: BLE001  the planted one only
        if "a fault on purpose" not in str(fault):
            raise
    return read_table(spark, root, "mart_customer_metrics")


def _appended_orders(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of orders from CSV files into one raw table, each of them done twice: the repetition adds nothing."""
    folder, rows = f"{shared_dir(spark)}/{uuid.uuid4().hex}", sales.orders(spark, d)
    early = F.col("order_date") < as_of_column(LOADED_UNTIL)
    for number, part in enumerate((rows.filter(early), rows.filter(~early))):
        export_csv(part, f"{folder}/{number}/orders.csv")
        for _ in range(2):
            load = bronze.load_id(spark, f"{folder}/{number}", "orders.csv")
            append_table(read_raw(spark, f"{folder}/{number}", "raw_orders"), f"{folder}/tables", "raw_orders", load)
    return read_table(spark, f"{folder}/tables", "raw_orders")


def _missing_files(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every raw table from a folder that lacks two of the files; none where the file is missing."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    export_csv(sales.customers(spark, d), f"{folder}/customers.csv")
    export_csv(sales.products(spark, d), f"{folder}/products.csv")
    found = []
    for table in RAW_FILES.values():
        try:
            found.append((table, read_raw(spark, folder, table).count()))
        except FileNotFoundError:
            found.append((table, None))
    return spark.createDataFrame(found, "table string, n_rows long")


def _empty_marts(spark: SparkSession, d: str) -> DataFrame:
    """Whether scoring stops for want of rows, on a day with orders in the year before and on one without."""
    found = []
    for day in (sales.AS_OF, NO_ORDERS_AS_OF):
        try:
            rfm.rfm_segments(stage(rfm.rfm_base(sales.orders(spark, d), day)))
            found.append((day, False))
        except RuntimeError:
            found.append((day, True))
    return spark.createDataFrame(found, "day string, stopped boolean")


def _recreated_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The cluster mart, dropped with all its versions and made anew."""
    root, rows = f"{shared_dir(spark)}/{uuid.uuid4().hex}", stage(_assigned(spark, d))
    replace_table(rows.withColumn("cluster_id", F.lit(-1)), root, "mart_customer_clusters")
    drop_table(spark, root, "mart_customer_clusters")
    replace_table(rows, root, "mart_customer_clusters")
    return read_table(spark, root, "mart_customer_clusters")


def _daily_job(spark: SparkSession, d: str) -> DataFrame:
    """The metrics mart that the whole job leaves, from compressed CSV files."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    inputs = {"customers": sales.customers, "products": sales.products, "orders": sales.orders, "order_items": sales.items_with_ids}
    for name, rows in inputs.items():
        export_csv(rows(spark, d), f"{folder}/raw/{name}.csv", "gzip")
    root, _ = run_all(spark, f"{folder}/raw", f"{folder}/out", sales.AS_OF, tidy=False)
    return read_table(spark, root, "mart_customer_metrics")


def _two_loads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to one day, and a batch that corrects the last year of them and adds the rest."""
    rows = sales.orders(spark, d)
    target = rows.filter(F.col("order_date") < as_of_column(LOADED_UNTIL))
    shipping = F.lit(RELOAD_SHIPPING).cast("decimal(12,2)")
    batch = (
        rows.filter(F.col("order_date") >= as_of_column(RELOAD_FROM))
        .withColumn("shipping_total", shipping)
        .withColumn("order_total", (F.col("order_total") + shipping).cast("decimal(12,2)"))
    )
    return target, batch


def _upsert_orders(spark: SparkSession, d: str) -> DataFrame:
    return upsert(*_two_loads(spark, d), KEYS["fact_orders"])


def _published_views(spark: SparkSession, d: str) -> DataFrame:
    """Rows and money behind the views of the catalog, asked for in plain SQL."""
    root, database = f"{shared_dir(spark)}/{uuid.uuid4().hex}", f"retail_{uuid.uuid4().hex}"
    replace_table(sales.orders(spark, d), root, "fact_orders")
    replace_table(_faulty_items(spark, d).withColumn("order_item_id", F.lit(1)), root, "fact_order_items")
    publish(spark, root, database)
    views = {"v_orders_completed": "order_total", "v_orders_non_cancelled": "order_total", "v_order_items_clean": "line_total"}
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{v}' AS view, count(*) AS n_rows, CAST(sum({amount}) AS decimal(22,2)) AS amount FROM {database}.{v}"
            for v, amount in views.items()
        )
    )


def _insert_new_dates(spark: SparkSession, d: str) -> DataFrame:
    """Known dates keep their row (marked by week 0); dates not seen before are added."""
    dates = _date_rows(spark, d)
    known = dates.filter(F.col("date_key") < as_of_column(LOADED_UNTIL)).withColumn("week", F.lit(0))
    return insert_new(known, dates, KEYS["dim_date"])


def _clean_items(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_items(sales.items_with_ids(spark, d), sales.orders(spark, d), measured=sales.items(spark, d))


def _metrics_as_of(spark: SparkSession, d: str, as_of: str | None) -> DataFrame:
    return c360.customer_360(sales.customers(spark, d), sales.products(spark, d), sales.orders(spark, d), sales.items(spark, d), as_of)


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return _metrics_as_of(spark, d, sales.AS_OF)


def _base(spark: SparkSession, d: str) -> DataFrame:
    return rfm.rfm_base(sales.orders(spark, d), sales.AS_OF)


def _base_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A mart kept up by upserts: customers without recent orders keep their earlier row."""
    orders = sales.orders(spark, d)
    return upsert(rfm.rfm_base(orders, EARLIER_AS_OF), rfm.rfm_base(orders, sales.AS_OF), KEYS["mart_rfm_base"])


def _rfm_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Position of every customer by monetary value, ties by id, and the quintile of that position."""
    base = stage(_base(spark, d).select("customer_id", "monetary_value"))
    ranked = global_rank(base, ["monetary_value", "customer_id"])
    return ranked.withColumn("quintile", quintile_of_rank(F.col("rank"), F.lit(base.count())))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return rfm.rfm_scored(stage(_base(spark, d)))


def _segment_counts(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("segment").agg(F.count("*").alias("customers"))


def _segment_report(spark: SparkSession, d: str) -> DataFrame:
    base = stage(_base(spark, d))
    return report_segments(rfm.rfm_scored(base), base)


def _features(spark: SparkSession, d: str) -> DataFrame:
    return cluster_features(_metrics(spark, d))


def _standardized(spark: SparkSession, d: str) -> DataFrame:
    scaled = standardize(stage(_features(spark, d)), COLUMNS)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in COLUMNS])


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    return assign_clusters(stage(_features(spark, d)), CENTERS)


def _points(spark: SparkSession, d: str) -> DataFrame:
    return stage(standardize(stage(_features(spark, d)), COLUMNS).select("customer_id", *COLUMNS))


def _silhouette_fixed(spark: SparkSession, d: str) -> DataFrame:
    """The silhouette of given centres, from all customers."""
    found = score_centers(_points(spark, d), COLUMNS, {len(CENTERS): CENTERS})
    return spark.createDataFrame([(k, round(s, 5)) for k, s in found.items()], "k int, silhouette double")


def _lloyd_fixed(spark: SparkSession, d: str) -> DataFrame:
    """Customers per centre and the centres' places after a few steps from given centres."""
    points, centers = _points(spark, d), {"fixed": CENTERS}
    for _ in range(LLOYD_STEPS):
        centers = lloyd_step(points, COLUMNS, centers)
    sizes = points.groupBy(nearest_center(COLUMNS, centers["fixed"]).alias("cluster_id")).agg(F.count("*").alias("customers"))
    rows = [(i, *[round(x, 4) for x in c]) for i, c in enumerate(centers["fixed"])]
    placed = spark.createDataFrame(rows, "cluster_id int, " + ", ".join(f"{c} double" for c in COLUMNS))
    return placed.join(sizes, "cluster_id", "left").withColumn("customers", F.coalesce("customers", F.lit(0)))


def _choose_k_fixed(spark: SparkSession, d: str) -> DataFrame:
    """The best of six given sets of centres."""
    found = score_centers(_points(spark, d), COLUMNS, CENTER_SETS)
    best = best_k(found)
    return spark.createDataFrame([(k, round(s, 5), k == best) for k, s in found.items()], "k int, silhouette double, chosen boolean")


def _choose_k(spark: SparkSession, d: str) -> DataFrame:
    features = stage(_features(spark, d))
    best, scores, _ = choose_k(standardize(features, COLUMNS), "customer_id", COLUMNS)
    return spark.createDataFrame(
        [(k, round(float(s), 5), k == best) for k, s in scores.items()], "k int, silhouette double, chosen boolean"
    )


QUERIES: dict[str, Query] = {
    "csv_customers": lambda s, d: _through_csv(s, "raw_customers", sales.customers(s, d)),
    "csv_products": lambda s, d: _through_csv(s, "raw_products", sales.products(s, d)),
    "csv_order_items": lambda s, d: _through_csv(s, "raw_order_items", sales.items_with_ids(s, d)),
    "csv_orders": lambda s, d: _through_csv(s, "raw_orders", sales.orders(s, d)),
    "stored_orders": _stored_orders,
    "dim_customers": lambda s, d: bronze.dimension_rows(_repeated(sales.customers(s, d), "customer_id", 3), "dim_customers"),
    "dim_products": lambda s, d: bronze.dimension_rows(_repeated(sales.products(s, d), "product_id", 3), "dim_products"),
    "dim_date": _date_rows,
    "fact_orders": lambda s, d: bronze.fact_rows(sales.orders(s, d), "fact_orders"),
    "fact_order_items": lambda s, d: bronze.fact_rows(sales.items_with_ids(s, d), "fact_order_items"),
    "upsert_orders": _upsert_orders,
    "insert_new_dates": _insert_new_dates,
    "orders_completed": lambda s, d: silver.completed(sales.orders(s, d)),
    "orders_non_cancelled": lambda s, d: silver.non_cancelled(sales.orders(s, d)),
    "published_views": _published_views,
    "items_clean": _clean_items,
    "basket_size": lambda s, d: c360.basket_size(sales.items(s, d), sales.orders(s, d)),
    "category_revenue": lambda s, d: c360.category_revenue(sales.items(s, d), sales.orders(s, d), sales.products(s, d)),
    "dominant_category": lambda s, d: c360.dominant_category(sales.items(s, d), sales.orders(s, d), sales.products(s, d)),
    "returns_rate": lambda s, d: c360.returns_rate(sales.orders(s, d)),
    "purchase_frequency": lambda s, d: c360.purchase_frequency(sales.orders(s, d)),
    "purchase_frequency_strict": lambda s, d: c360.purchase_frequency(sales.orders(s, d), strict_months=True),
    "customer_base": lambda s, d: c360.customer_base(sales.customers(s, d), sales.orders(s, d)),
    "customer_360": _metrics,
    "customer_360_today": lambda s, d: _metrics_as_of(s, d, None),
    "stored_marts": _stored_marts,
    "appended_orders": _appended_orders,
    "missing_files": _missing_files,
    "empty_marts": _empty_marts,
    "preview_orders": lambda s, d: preview(sales.orders(s, d), 2, "order_id"),
    "recreated_clusters": _recreated_clusters,
    "daily_job": _daily_job,
    "rfm_base": _base,
    "rfm_base_upsert": _base_upsert,
    "rfm_ranks": _rfm_ranks,
    "rfm_segments": lambda s, d: rfm.rfm_segments(stage(_base(s, d))),
    "rfm_scored": _scored,
    "rfm_segment_counts": _segment_counts,
    "cohort_first_purchase": lambda s, d: first_purchase(sales.orders(s, d)),
    "cohort_retention": lambda s, d: cohort_retention(sales.orders(s, d)),
    "retention_curve": lambda s, d: report_retention_curve(cohort_retention(sales.orders(s, d))),
    "segment_report": _segment_report,
    "dq_report": lambda s, d: dq_report(_faulty_orders(s, d), _faulty_items(s, d)),
    "dq_unique_keys": lambda s, d: dq_unique_keys(_tables(s, d, item_ids=True), KEYS),
    "dq_foreign_keys": lambda s, d: dq_foreign_keys(_tables(s, d), REFERENCES),
    "dq_accepted_values": lambda s, d: dq_accepted_values(_tables(s, d)),
    "dq_reconcile": lambda s, d: dq_reconcile(_faulty_orders(s, d), order_rollup(_faulty_items(s, d))),
    "cluster_features": _features,
    "standardized_features": _standardized,
    "cluster_assign_fixed": _assigned,
    "cluster_profile_fixed": lambda s, d: cluster_profile(_assigned(s, d)),
    "cluster_report_fixed": lambda s, d: report_clusters(_assigned(s, d)),
    "silhouette_fixed": _silhouette_fixed,
    "lloyd_fixed": _lloyd_fixed,
    "choose_k_fixed": _choose_k_fixed,
    "kmeans_choose_k": _choose_k,
    "customer_clusters": lambda s, d: cluster_customers(_metrics(s, d))[0],
}
