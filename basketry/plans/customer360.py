"""One row of metrics per customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import age_month_field, as_of_column, full_months
from ..functions.numbers import mean_of, ratio
from ..operators.hot_keys import join_heavy
from ..schemas import conform
from ..sources.staging import stage
from .silver import COMPLETED, RETURNED, clean_items, non_cancelled, valid_items


def items_per_order(items: DataFrame) -> DataFrame:
    """Units per order. Items shrink to one row per order and map task before they are shuffled."""
    return valid_items(items).groupBy("order_id").agg(F.sum("quantity").alias("items_per_order"))


def basket_size(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean units per order and customer, over orders that have clean items."""
    rolled = items_per_order(items).join(non_cancelled(orders).select("order_id", "customer_id"), "order_id")
    total, n = F.sum("items_per_order").cast("decimal(20,0)"), F.count("items_per_order")
    return rolled.groupBy("customer_id").agg(mean_of(total, n, "decimal(14,2)").alias("avg_basket_size"))


def category_revenue(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Clean line totals per customer and category. Items of unknown products have no category to count in."""
    lines = clean_items(items.select("order_id", "product_id", "quantity", "unit_price", "line_total"), orders, ["customer_id"])
    return (
        join_heavy(lines, products.select("product_id", "category"), "product_id", items)
        .groupBy("customer_id", "category")
        .agg(F.sum("line_total").alias("cat_revenue"))
    )


def dominant_category(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The category with most revenue per customer, the first by name on ties; unknown revenue ranks highest."""
    return _dominant(category_revenue(items, orders, products))


def _dominant(by_category: DataFrame) -> DataFrame:
    revenue = F.col("cat_revenue")
    order = F.struct(revenue.isNotNull(), -revenue, F.col("category").isNull(), F.col("category"))
    return by_category.groupBy("customer_id").agg(F.min_by("category", order).alias("dominant_category"))


def _frequency(strict_months: bool):
    """Orders per month between first and last order.

    Default: the month part of the age between them, with whole years dropped; a span of one month or less
    has no frequency. strict_months counts all elapsed months, at least one.
    """
    first, last = F.min("order_date"), F.max("order_date")
    if strict_months:
        months = F.greatest(full_months(last, first), F.lit(1))
    else:
        months = F.nullif(F.greatest(age_month_field(last, first), F.lit(1)), F.lit(1))
    return ratio(F.count_distinct("order_id"), months, "decimal(14,4)")


def _order_metrics(strict_months: bool = False) -> dict:
    """Aggregates over a customer's non-cancelled orders, all computed in one pass."""
    is_completed = F.col("status") == COMPLETED
    sold = F.when(is_completed, F.col("order_total"))
    return {
        "first_purchase_date": F.min("order_date"),
        "last_purchase_date": F.max("order_date"),
        "total_orders": F.count_distinct("order_id").cast("int"),
        "total_revenue": F.sum(F.when(is_completed, F.col("order_total")).otherwise(0)).cast("decimal(14,2)"),
        "avg_order_value": mean_of(F.sum(sold), F.count(sold), "decimal(14,2)"),
        "purchase_frequency_per_mo": _frequency(strict_months),
        "returns_rate": ratio(F.count_if(F.col("status") == RETURNED), F.count("*"), "decimal(10,4)"),
    }


def _per_customer(orders: DataFrame, names: list[str], strict_months: bool = False) -> DataFrame:
    metrics = _order_metrics(strict_months)
    return non_cancelled(orders).groupBy("customer_id").agg(*[metrics[n].alias(n) for n in names])


def returns_rate(orders: DataFrame) -> DataFrame:
    """Returned share of each customer's non-cancelled orders."""
    return _per_customer(orders, ["returns_rate"])


def purchase_frequency(orders: DataFrame, strict_months: bool = False) -> DataFrame:
    return _per_customer(orders, ["purchase_frequency_per_mo"], strict_months)


def customer_base(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order dates, count and value for every customer, also those without orders."""
    names = ["first_purchase_date", "last_purchase_date", "total_orders", "total_revenue", "avg_order_value"]
    return (
        customers.select("customer_id")
        .join(_per_customer(orders, names), "customer_id", "left")
        .withColumn("total_orders", F.coalesce("total_orders", F.lit(0)))
        .withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0).cast("decimal(14,2)")))
        .select("customer_id", *names)
    )


def customer_360(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    as_of: date | str | None = None,
    strict_months: bool = False,
) -> DataFrame:
    """The customer metrics mart.

    The items are read once: valid lines are added up by order and category, with a mark for known products,
    before they are shuffled. Baskets (all lines) and dominant category (lines of known products) start from
    that stored table. Orders are aggregated per customer once, for dates, value, frequency and returns.
    """
    known = products.select("product_id", "category", F.lit(True).alias("known"))
    lines = valid_items(items).join(known, "product_id", "left").groupBy("order_id", "category", "known")
    lines = stage(lines.agg(F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue")), "zstd")
    per_order = lines.groupBy("order_id").agg(F.sum("units").alias("items_per_order"))
    with_units = non_cancelled(orders).join(per_order, "order_id", "left")
    units, n = F.sum("items_per_order").cast("decimal(20,0)"), F.count("items_per_order")
    metrics = _order_metrics(strict_months) | {"avg_basket_size": mean_of(units, n, "decimal(14,2)")}
    per_customer = with_units.groupBy("customer_id").agg(*[m.alias(name) for name, m in metrics.items()])
    sold = lines.filter("known").join(non_cancelled(orders).select("order_id", "customer_id"), "order_id")
    by_category = sold.groupBy("customer_id", "category").agg(F.sum("revenue").alias("cat_revenue"))
    zero_if_none = [
        "total_orders", "total_revenue", "avg_order_value", "avg_basket_size", "purchase_frequency_per_mo", "returns_rate",
    ]
    joined = (
        customers.select("customer_id")
        .join(per_customer, "customer_id", "left")
        .join(_dominant(by_category), "customer_id", "left")
        .withColumns({name: F.coalesce(name, F.lit(0)) for name in zero_if_none})
        .withColumn("days_since_last_purchase", F.date_diff(as_of_column(as_of), "last_purchase_date"))
    )
    return conform(joined, "mart_customer_metrics")
