"""Column names and types of every table, raw to mart, and the cast that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

_CUSTOMER = "customer_id int, signup_date date, country string, channel string, email_domain string, is_active boolean"
_PRODUCT = "product_id int, category string, brand string, unit_cost decimal(10,2)"
_ORDER = (
    "order_id bigint, customer_id int, order_date date, status string, payment_type string, "
    "order_total decimal(12,2), discount_total decimal(12,2), shipping_total decimal(12,2)"
)
_ITEM = (
    "order_item_id bigint, order_id bigint, product_id int, quantity int, "
    "unit_price decimal(12,2), line_total decimal(12,2)"
)

_DDL = {
    "raw_customers": _CUSTOMER,
    "raw_products": _PRODUCT,
    "raw_orders": _ORDER,
    "raw_order_items": _ITEM,
    "dim_customers": _CUSTOMER,
    "dim_products": _PRODUCT,
    "dim_date": "date_key date, year int, month int, day int, week int, day_name string, month_name string",
    "fact_orders": _ORDER,
    "fact_order_items": _ITEM,
    "mart_customer_metrics": (
        "customer_id int, first_purchase_date date, last_purchase_date date, total_orders int, "
        "total_revenue decimal(14,2), avg_order_value decimal(14,2), avg_basket_size decimal(14,2), "
        "purchase_frequency_per_mo decimal(14,4), days_since_last_purchase int, "
        "returns_rate decimal(10,4), dominant_category string"
    ),
    "mart_rfm_base": "customer_id int, recency_days int, frequency_orders int, monetary_value decimal(14,2)",
    "mart_rfm_scored": "customer_id int, r_score int, f_score int, m_score int, rfm_score int, segment string",
    "mart_cohort_retention": (
        "cohort_month date, active_month date, cohort_size int, active_users int, retention_rate decimal(10,4)"
    ),
    "mart_customer_clusters": (
        "customer_id int, cluster_id int, total_orders int, total_revenue decimal(14,2), "
        "avg_order_value decimal(14,2), avg_basket_size decimal(14,2), purchase_frequency_per_mo decimal(14,4), "
        "days_since_last_purchase int, returns_rate decimal(10,4)"
    ),
}

_JSON_NAMES = {"int": "integer", "bigint": "long"}


def _struct(ddl: str) -> StructType:
    """StructType.fromDDL without the running session it needs."""
    fields = [column.split(" ") for column in ddl.split(", ")]
    return StructType.fromJson(
        {
            "type": "struct",
            "fields": [
                {"name": name, "type": _JSON_NAMES.get(kind, kind), "nullable": True, "metadata": {}}
                for name, kind in fields
            ],
        }
    )


SCHEMAS: dict[str, StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# Primary keys. raw_* tables and the cohort mart have none.
KEYS: dict[str, list[str]] = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_id"],
    "fact_order_items": ["order_item_id"],
    "mart_customer_metrics": ["customer_id"],
    "mart_rfm_base": ["customer_id"],
    "mart_rfm_scored": ["customer_id"],
    "mart_customer_clusters": ["customer_id"],
}

# Sort order of the stored facts. Files then cover narrow ranges: a date filter skips whole files by their
# statistics, and the items of an order lie together, so they add up before they are shuffled. The key
# comes second, so a date or order with very many rows still spreads over files.
CLUSTERED_BY: dict[str, list[str]] = {
    "fact_orders": ["order_date", "order_id"],
    "fact_order_items": ["order_id", "order_item_id"],
}

# Facts are stored in slices, so that a batch rewrites only those it touches: orders by month, items, which carry
# no date, by ranges of order ids (new orders have high ones). The names are SQL expressions.
ORDERS_PER_SLICE = 5_000_000
SLICED_BY: dict[str, str] = {
    "fact_orders": "date_format(order_date, 'yyyy-MM')",
    "fact_order_items": f"order_id div {ORDERS_PER_SLICE}",
}

# Foreign keys: (child table, child column, parent table, parent column).
REFERENCES: list[tuple[str, str, str, str]] = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "order_date", "dim_date", "date_key"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project `df` to exactly the columns and types of `table`."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table]])
