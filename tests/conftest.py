from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from helpers import frame  # noqa: E402

from basketry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edge(spark):
    """Hand-made tables for branches the sales data never reach; reporting date AS_OF."""
    order = lambda i, c, d, s, t: (i, c, d, s, "card", t, "0.00", "0.00")
    return {
        "customers": frame(spark, "dim_customers", [(i, "2022-01-01", "US", "web", "gmail.com", True) for i in range(1, 8)]),
        "products": frame(
            spark,
            "dim_products",
            [(10, "Electronics", "Nova", "1.00"), (11, "Home", "Apex", "1.00"), (12, "Apparel", "Orbit", "1.00")],
        ),
        "orders": frame(
            spark,
            "fact_orders",
            [
                order(1001, 1, "2024-01-31", "completed", "100.00"),
                order(1002, 1, "2024-02-28", "completed", "50.01"),
                order(1003, 2, "2023-01-15", "completed", "10.00"),
                order(1004, 2, "2024-03-15", "returned", "20.00"),
                order(1005, 3, "2024-05-01", "cancelled", "0.00"),
                order(1006, 5, "2023-07-01", "completed", "33.33"),
                order(1007, 6, "2023-06-30", "completed", "44.44"),
                order(1008, 5, "2024-01-01", "completed", "66.67"),
                order(1009, 6, "2024-06-30", "returned", "5.55"),
                order(1010, 7, "2024-01-10", "completed", "12.00"),
            ],
        ),
        "items": frame(
            spark,
            "fact_order_items",
            [
                (1, 1001, 10, 2, "25.00", "50.00"),
                (2, 1001, 11, 1, "50.00", "50.00"),
                (3, 1002, 10, 0, "50.01", "50.01"),
                (4, 1003, 12, 1, "10.00", "10.00"),
                (5, 1004, 11, 4, "5.00", "20.00"),
                (6, 1005, 10, 1, "9.00", "0.00"),
                (7, 1006, 12, 1, "33.33", "33.33"),
                (8, 1008, 12, 1, "66.67", "66.67"),
                (9, 1007, 10, 1, "44.44", "44.44"),
                (10, 1009, 11, 1, "5.55", "5.55"),
                (11, 9999, 10, 1, "1.00", "1.00"),
                (12, 1010, 12, 3, "4.00", "12.00"),
            ],
        ),
    }
