"""What the daily job shuffles and writes (finding F2 of round 3)."""

import pytest
from helpers import frame
from pyspark.sql import functions as F

from basketry.operators.keyed_writes import upsert
from basketry.plans import bronze
from basketry.schemas import KEYS
from basketry.sources.csv_files import export_csv, read_raw
from basketry.sources.tables import read_table, replace_table

ORDERS = [(i, 1, "2024-01-02", "completed", "card", "1.00", "0.25", "0.00") for i in range(1, 6)]


def test_a_first_load_is_not_joined_to_the_table_that_is_not_there(spark, tmp_path):
    batch = frame(spark, "fact_orders", ORDERS)
    made = upsert(read_table(spark, str(tmp_path), "fact_orders"), batch, KEYS["fact_orders"])
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(made.collect()) == sorted(batch.collect())
    twice = upsert(read_table(spark, str(tmp_path), "fact_orders"), batch.union(batch), KEYS["fact_orders"])
    with pytest.raises(Exception, match="NULL or not unique"):
        twice.collect()


def test_stored_tables_are_dense(spark, tmp_path):
    replace_table(frame(spark, "fact_orders", ORDERS), str(tmp_path), "fact_orders")
    files = list((tmp_path / "fact_orders" / "data").rglob("*.parquet"))
    assert files and all(".zstd." in f.name for f in files)
    assert read_table(spark, str(tmp_path), "fact_orders").count() == 5


def test_compressed_files_load_as_plain_ones_do(spark, tmp_path):
    rows = frame(spark, "raw_orders", ORDERS)
    for kind in (None, "gzip"):
        export_csv(rows.repartition(2), f"{tmp_path}/{kind}/orders.csv", kind)
    assert list((tmp_path / "gzip" / "orders.csv").glob("*.csv.gz"))
    plain, dense = (read_raw(spark, f"{tmp_path}/{kind}", "raw_orders") for kind in (None, "gzip"))
    assert sorted(plain.collect()) == sorted(dense.collect()) == sorted(rows.collect())
    assert bronze.load_id(spark, f"{tmp_path}/gzip", "orders.csv").split("-")[1] == bronze.load_id(spark, f"{tmp_path}/None", "orders.csv").split("-")[1]
    assert dense.agg(F.sum("order_total")).first()[0] == 5
