"""Data-quality checks. Every check is one row: its name, whether it passed, and how many rows are bad.

Checks report and never fail a run. Key checks count per key first, so neither a NULL key nor a key that
holds most rows gathers its rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .keyed_writes import key_violations

# Accepted values per table and column.
ACCEPTED = {
    "dim_customers": {
        "country": ["US", "CA", "GB", "IN", "AU"],
        "channel": ["web", "mobile", "marketplace"],
        "email_domain": ["gmail.com", "outlook.com", "yahoo.com", "proton.me"],
    },
    "dim_products": {
        "category": ["Electronics", "Apparel", "Home", "Beauty", "Sports", "Grocery"],
        "brand": ["Nova", "Apex", "Zenith", "Orbit", "Pulse", "Vertex"],
    },
    "fact_orders": {
        "status": ["completed", "cancelled", "returned"],
        "payment_type": ["card", "paypal", "apple_pay", "google_pay"],
    },
}


def check_rows(df: DataFrame, bad_rows: dict[str, Column]) -> DataFrame:
    """One pass over `df`: a check row per entry of {check name: aggregate counting bad rows}."""
    counted = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"c{i}") for i, c in enumerate(bad_rows.values())])
    named = [F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("bad_rows")) for i, name in enumerate(bad_rows)]
    rows = counted.select(F.explode(F.array(*named)).alias("row")).select("row.*")
    return rows.select("check", (F.col("bad_rows") == 0).alias("passed"), "bad_rows")


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rows_per_key(child: DataFrame, column: str) -> DataFrame:
    return child.groupBy(column).agg(F.count("*").alias("n_rows"))


def orphan_rows(counted: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys of `counted`, one row per key with its `n_rows`, that have no parent; a NULL key has none."""
    keys = counted.select(F.col(column).alias("key"), "n_rows")
    return keys.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


def order_rollup(items: DataFrame) -> DataFrame:
    """What the checks need to know about the items of an order, one row per order."""
    line = F.col("line_total")
    return items.groupBy("order_id").agg(
        F.count("*").alias("n_rows"),
        F.sum(line).alias("lines_total"),
        F.count_if(line != F.round(F.col("unit_price") * F.col("quantity"), 2)).alias("lines_off"),
        F.count_if(line != 0).alias("lines_not_zero"),
    )


def dq_report(orders: DataFrame, items: DataFrame, rollup: DataFrame | None = None) -> DataFrame:
    """The three standing checks. A stored `order_rollup` saves counting the items again."""
    negative = (F.col("status") == "completed") & (F.col("order_total") < 0)
    counted = rows_per_key(items, "order_id") if rollup is None else rollup
    orphans = orphan_rows(counted, "order_id", orders, "order_id")
    return _stack(
        [
            check_rows(orders, {"no_negative_revenue_completed": F.count_if(negative)}),
            check_rows(items, {"positive_quantity_items": F.count_if(F.col("quantity") <= 0)}),
            check_rows(orphans, {"no_orphan_order_items": F.sum("n_rows")}),
        ]
    )


def dq_unique_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Per table, rows whose key is NULL or shared with another row."""
    return _stack(
        [
            check_rows(key_violations(df, keys[name]), {f"unique_key:{name}": F.sum("n_rows")})
            for name, df in tables.items()
        ]
    )


def dq_foreign_keys(
    tables: dict[str, DataFrame],
    references: list[tuple[str, str, str, str]],
    counted: dict[tuple[str, str], DataFrame] | None = None,
) -> DataFrame:
    """Per reference, child rows whose key is set but has no parent row.

    `counted` may hold rows per key already stored, by (child table, column).
    """
    checks = []
    for child, column, parent, parent_column in references:
        keys = (counted or {}).get((child, column))
        if keys is None:
            keys = rows_per_key(tables[child], column)
        orphans = orphan_rows(keys.filter(F.col(column).isNotNull()), column, tables[parent], parent_column)
        checks.append(check_rows(orphans, {f"foreign_key:{child}.{column}": F.sum("n_rows")}))
    return _stack(checks)


def dq_accepted_values(tables: dict[str, DataFrame], accepted: dict[str, dict[str, list[str]]] = ACCEPTED) -> DataFrame:
    """Per column, rows with a value outside its list; NULL is not a value."""
    return _stack(
        [
            check_rows(
                tables[name],
                {f"accepted_values:{name}.{c}": F.count_if(~F.col(c).isin(values)) for c, values in columns.items()},
            )
            for name, columns in accepted.items()
        ]
    )


def dq_reconcile(orders: DataFrame, rollup: DataFrame) -> DataFrame:
    """Line and order amounts against each other, from the orders and the `order_rollup` of their items."""
    joined = orders.join(rollup, "order_id", "left")
    cancelled = F.col("status") == "cancelled"
    expected = F.coalesce("lines_total", F.lit(0)) - F.col("discount_total") + F.col("shipping_total")
    any_amount = (F.col("order_total") != 0) | (F.col("discount_total") != 0) | (F.col("shipping_total") != 0)
    return check_rows(
        joined,
        {
            "line_total_is_price_times_quantity": F.sum(F.when(~cancelled, F.col("lines_off"))),
            "order_total_is_lines_less_discount_plus_shipping": F.count_if(~cancelled & (F.col("order_total") != expected)),
            "cancelled_orders_are_zero": F.count_if(cancelled & any_amount),
            "cancelled_lines_are_zero": F.sum(F.when(cancelled, F.col("lines_not_zero"))),
        },
    )
