"""Cleaned order and item rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.hot_keys import join_heavy

# Order status.
COMPLETED = "completed"
RETURNED = "returned"

# The rules of the views, stated once for frames and for catalog users.
_COMPLETED = f"status = '{COMPLETED}'"
_NON_CANCELLED = f"status IN ('{COMPLETED}', '{RETURNED}')"
_VALID = "quantity > 0 AND unit_price >= 0"

# Stored tables that each view stands on, and its text; {schema} is the database prefix.
VIEW_SQL = {
    "v_orders_completed": (["fact_orders"], f"SELECT * FROM {{schema}}fact_orders WHERE {_COMPLETED}"),
    "v_orders_non_cancelled": (["fact_orders"], f"SELECT * FROM {{schema}}fact_orders WHERE {_NON_CANCELLED}"),
    "v_order_items_clean": (
        ["fact_orders", "fact_order_items"],
        "SELECT i.* FROM {schema}fact_order_items i JOIN {schema}v_orders_non_cancelled o ON o.order_id = i.order_id "
        f"WHERE {_VALID}",
    ),
}


def completed(orders: DataFrame) -> DataFrame:
    return orders.filter(_COMPLETED)


def non_cancelled(orders: DataFrame) -> DataFrame:
    return orders.filter(_NON_CANCELLED)


def valid_items(items: DataFrame) -> DataFrame:
    """Items with something sold at a price; rows with NULL in either go too."""
    return items.filter(_VALID)


def clean_items(items: DataFrame, orders: DataFrame, carry: list[str] | None = None, measured: DataFrame | None = None) -> DataFrame:
    """Valid items of non-cancelled orders, with the order columns named in `carry` added.

    Both filters and the needed columns reach the scans. An order holding very many items is spread over tasks (see
    `join_heavy`; `measured`, if given, has the items' order ids and is cheaper to read).
    """
    carry = carry or []
    parents = non_cancelled(orders).select("order_id", *carry)
    return join_heavy(valid_items(items), parents, "order_id", measured).select(*items.columns, *carry)


def register_views(orders: DataFrame, items: DataFrame) -> None:
    """Temp views over the given frames under the usual names."""
    orders.createOrReplaceTempView("fact_orders")
    items.createOrReplaceTempView("fact_order_items")
    for view, (_, text) in VIEW_SQL.items():
        orders.sparkSession.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS {text.format(schema='')}")
