from __future__ import annotations

import csv
import os
import random
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from helpers import frame

from basketry.plans.bronze import build_dims, build_facts, load_raw, upsert_table
from basketry.sources import versions
from basketry.sources.csv_files import export_csv, read_raw
from basketry.sources.quoted_lines import starts
from basketry.sources.staging import drop_staged, shared_dir, stage, usable
from basketry.sources.tables import append_table, drop_table, has_table, preview, publish, read_table, replace_table, require_rows, table_version

FILES = {
    "customers.csv": "customer_id,signup_date,country,channel,email_domain,is_active\n1,2024-01-05,US,web,gmail.com,True\n2,,NA,mobile,\"a,b \"\"c\"\"\",False\n",
    "products.csv": "product_id,category,brand,unit_cost\n1,Home,Nova,12.5\n",
    "orders.csv": "order_id,customer_id,order_date,status,payment_type,order_total,discount_total,shipping_total\n10,1,2024-02-01,completed,card,20.10,0.0,1.25\n",
    "order_items.csv": "order_item_id,order_id,product_id,quantity,unit_price,line_total\n100,10,1,2,9.425,18.85\n",
}


@pytest.fixture
def raw_dir(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def test_read_raw(spark, raw_dir):
    assert [tuple(r) for r in read_raw(spark, str(raw_dir), "raw_customers").collect()] == [
        (1, date(2024, 1, 5), "US", "web", "gmail.com", True),
        (2, None, None, "mobile", 'a,b "c"', False),
    ]
    assert read_raw(spark, str(raw_dir), "raw_order_items").first().unit_price == Decimal("9.43")


def test_columns_go_by_name(spark, raw_dir):
    (raw_dir / "products.csv").write_text("unit_cost,product_id,category\n3.00,7,Home\n")
    assert tuple(read_raw(spark, str(raw_dir), "raw_products").first()) == (7, "Home", None, Decimal("3.00"))
    (raw_dir / "products.csv").write_text("product_id,colour\n7,red\n")
    with pytest.raises(ValueError, match="colour"):
        read_raw(spark, str(raw_dir), "raw_products")


def test_bad_text_stops_the_job(spark, raw_dir):
    (raw_dir / "products.csv").write_text("product_id,category,brand,unit_cost\nseven,Home,Nova,1.00\n")
    with pytest.raises(Exception, match="column product_id: not a int: seven"):
        read_raw(spark, str(raw_dir), "raw_products").collect()


def test_missing_file(spark, raw_dir):
    (raw_dir / "orders.csv").unlink()
    with pytest.raises(FileNotFoundError, match="orders.csv"):
        load_raw(spark, str(raw_dir), str(raw_dir / "tables"))
    assert not has_table(spark, str(raw_dir / "tables"), "raw_customers")


def test_load_appends_or_truncates(spark, raw_dir):
    root = str(raw_dir / "tables")
    load_raw(spark, str(raw_dir), root)
    load_raw(spark, str(raw_dir), root)  # the same load again adds nothing
    assert read_table(spark, root, "raw_customers").count() == 2
    (raw_dir / "customers.csv").write_text("customer_id,country\n3,US\n")
    load_raw(spark, str(raw_dir), root)
    assert sorted(r.customer_id for r in read_table(spark, root, "raw_customers").collect()) == [1, 2, 3]
    assert read_table(spark, root, "raw_orders").count() == 1
    load_raw(spark, str(raw_dir), root, truncate=True)
    assert read_table(spark, root, "raw_customers").count() == 1


def test_a_load_that_fails_half_way_may_be_repeated(spark, raw_dir):
    root = str(raw_dir / "tables")
    good = (raw_dir / "order_items.csv").read_text()
    (raw_dir / "order_items.csv").write_text(good.replace("9.425", "cheap"))
    with pytest.raises(Exception, match="cheap"):
        load_raw(spark, str(raw_dir), root)
    (raw_dir / "order_items.csv").write_text(good)
    load_raw(spark, str(raw_dir), root)
    counts = [read_table(spark, root, t).count() for t in ("raw_customers", "raw_products", "raw_orders", "raw_order_items")]
    assert counts == [2, 1, 1, 1]
    build_dims(spark, root)
    build_facts(spark, root)  # a doubled key would stop here


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    root = str(tmp_path)
    assert not has_table(spark, root, "dim_products") and read_table(spark, root, "dim_products").count() == 0
    replace_table(frame(spark, "dim_products", [(1, "Home", "Nova", "1.00")]), root, "dim_products")
    old = read_table(spark, root, "dim_products")
    replace_table(old.unionByName(old.selectExpr("product_id + 1 as product_id", "category", "brand", "unit_cost")), root, "dim_products")
    assert sorted(r.product_id for r in read_table(spark, root, "dim_products").collect()) == [1, 2]
    assert [p.name for p in tmp_path.iterdir()] == ["dim_products"]


PRODUCT = (1, "Home", "Nova", "1.00")


@pytest.mark.parametrize("cut", ["data", "version", "tidy"])
def test_a_writer_cut_short_leaves_the_table(spark, tmp_path, monkeypatch, cut):
    """The process ends while it writes data, in the middle of the version's file, or before old files are gone."""
    root, table = str(tmp_path), "dim_products"
    for price in ("1.00", "2.00"):
        replace_table(frame(spark, table, [(1, "Home", "Nova", price)]), root, table)

    class Ended(BaseException):
        pass

    def end(*_, **__):
        raise Ended

    def half(spark, path, text, overwrite=False):
        Path(path).write_text(text[: len(text) // 2])
        raise Ended

    with monkeypatch.context() as patch:
        patch.setattr(versions, {"data": "commit", "version": "write_new", "tidy": "_tidy"}[cut], half if cut == "version" else end)
        with pytest.raises(Ended):
            replace_table(frame(spark, table, [(1, "Home", "Nova", "3.00"), (2, "Home", "Nova", "3.00")]), root, table)
    now = read_table(spark, root, table)
    assert [str(r.unit_cost) for r in now.collect()] == (["3.00", "3.00"] if cut == "tidy" else ["2.00"])
    before = now.count()
    replace_table(now.unionByName(frame(spark, table, [(9, "Home", "Nova", "4.00")])), root, table)
    assert read_table(spark, root, table).count() == before + 1
    named = {p.folder for v in versions._numbers(spark, f"{root}/{table}") for p in versions._load(spark, f"{root}/{table}", v).parts}
    assert {p.name for p in (tmp_path / table / "data").iterdir()} == named  # what was cut short is gone


def test_a_second_writer_is_refused(spark, tmp_path):
    root, table = str(tmp_path), "dim_products"
    replace_table(frame(spark, table, [PRODUCT]), root, table)
    seen = table_version(spark, root, table)
    append_table(frame(spark, table, [PRODUCT]), root, table)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.commit(spark, f"{root}/{table}", seen, [], [])
    assert read_table(spark, root, table).count() == 2


def test_readers_of_the_version_before_finish(spark, tmp_path):
    root, table = str(tmp_path), "dim_products"
    replace_table(frame(spark, table, [PRODUCT]), root, table)
    reader = read_table(spark, root, table)
    replace_table(reader.limit(0), root, table)
    assert reader.count() == 1 and read_table(spark, root, table).count() == 0
    drop_table(spark, root, table)
    assert not has_table(spark, root, table)


def _orders(spark, rows):
    return frame(spark, "fact_orders", [(i, 1, day, "completed", "card", total, "0.00", "0.00") for i, day, total in rows])


def _files(tmp_path):
    return {f: f.stat().st_mtime_ns for f in (tmp_path / "fact_orders" / "data").rglob("*.parquet")}


def test_a_batch_rewrites_the_months_it_touches(spark, tmp_path):
    root = str(tmp_path)
    stored = [(i, f"2024-{1 + i % 6:02d}-10", "1.00") for i in range(60)] + [(100, None, "1.00")]
    upsert_table(_orders(spark, stored), root, "fact_orders")
    before, parts = _files(tmp_path), table_version(spark, root, "fact_orders").parts
    assert [p.slice for p in parts] == [f"2024-{m:02d}" for m in range(1, 7)] + ["none"]
    # A correction within March, a new order in July, and order 4 (May) moved to March.
    batch = [(2, "2024-03-11", "5.00"), (200, "2024-07-01", "6.00"), (4, "2024-03-12", "7.00")]
    upsert_table(_orders(spark, batch), root, "fact_orders")
    now = {r.order_id: (str(r.order_date), str(r.order_total)) for r in read_table(spark, root, "fact_orders").collect()}
    assert now == {i: (str(d), t) for i, d, t in stored} | {i: (d, t) for i, d, t in batch}
    assert read_table(spark, root, "fact_orders").count() == 62
    kept = {p.slice for p in table_version(spark, root, "fact_orders").parts if p in parts}
    assert kept == {"2024-01", "2024-02", "2024-04", "2024-06", "none"}
    after = _files(tmp_path)
    assert all(after[f] == at for f, at in before.items() if any(f"_slice={m}/" in str(f) for m in kept))
    with pytest.raises(Exception, match="NULL or not unique"):
        upsert_table(_orders(spark, [(2, "2024-08-01", "1.00"), (2, "2024-08-02", "1.00")]), root, "fact_orders")
    assert read_table(spark, root, "fact_orders").count() == 62


def test_a_sliced_table_has_a_name_in_the_catalog(spark, tmp_path):
    upsert_table(_orders(spark, [(1, "2024-01-01", "1.00"), (2, "2024-02-01", "2.00")]), str(tmp_path), "fact_orders")
    for _ in range(2):
        publish(spark, str(tmp_path), "sliced_shop")
    assert spark.sql("SELECT sum(order_total) FROM sliced_shop.v_orders_completed").first()[0] == 3
    replace_table(_orders(spark, [(1, "2024-01-01", "1.00")]), str(tmp_path), "fact_orders")
    publish(spark, str(tmp_path), "sliced_shop")
    assert spark.table("sliced_shop.fact_orders").count() == 1


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    good = frame(spark, "dim_products", [(1, "Home", "Nova", "1.00")])
    replace_table(good, root, "dim_products")
    with pytest.raises(Exception):
        replace_table(good.selectExpr("raise_error('no') as product_id", "category", "brand", "unit_cost"), root, "dim_products")
    assert [p.name for p in tmp_path.iterdir()] == ["dim_products"]


def test_export_has_a_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", now')], "id int, v string").coalesce(1)
    export_csv(df, str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == 'id,v\n1,"say ""hi"", now"\n'


def test_preview(spark):
    assert preview(spark.range(9)).count() == 2


def test_require_rows(spark):
    df = spark.range(1)
    assert require_rows(df, "no rows") is df
    with pytest.raises(RuntimeError, match="no rows"):
        require_rows(df.limit(0), "no rows")


def test_stage_uses_the_configured_folder(spark):
    df = stage(spark.range(5))
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert df.count() == 5 and shared_dir(spark).split("/")[-1] in df.inputFiles()[0]
    drop_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(shared_dir(spark))
    drop_staged(spark)  # nothing left: harmless


def test_publish_takes_a_relative_root_and_what_is_stored(spark, tmp_path):
    root = os.path.relpath(tmp_path)
    publish(spark, root, "empty_shop")
    assert spark.sql("SHOW VIEWS IN empty_shop").filter("NOT isTemporary").count() == 0
    order = (1, 1, "2024-01-01", "completed", "card", "5.00", "0.00", "0.00")
    replace_table(frame(spark, "fact_orders", [order]), root, "fact_orders")
    publish(spark, root, "shop")
    assert spark.sql("SELECT * FROM shop.v_orders_completed").count() == 1
    assert {r.viewName for r in spark.sql("SHOW VIEWS IN shop").collect() if not r.isTemporary} == {"v_orders_completed", "v_orders_non_cancelled"}


def test_whole_numbers_with_a_point_and_line_breaks(spark, tmp_path):
    (tmp_path / "products.csv").write_text('product_id,category,brand,unit_cost\n1.0,"a\nb",Nova,2.50\n')
    row = read_raw(spark, str(tmp_path), "raw_products", line_breaks=True).first()
    assert (row.product_id, row.category) == (1, "a\nb")
    (tmp_path / "products.csv").write_text("product_id,category,brand,unit_cost\n1.5,a,Nova,2.50\n")
    with pytest.raises(Exception, match="column product_id: not a int: 1.5"):
        read_raw(spark, str(tmp_path), "raw_products").collect()


def test_line_breaks_in_a_file_of_many_splits(spark, tmp_path):
    """Records as Python's csv reads them, from splits that start anywhere, inside a cell or even inside a pair of quotes."""
    draw = random.Random(11)
    cell = lambda: "".join(draw.choice(['a', 'é', '"', ",", "\n", "\r\n", " ", "xyz"]) for _ in range(draw.randint(1, 9))) + "."
    rows = [(i, cell(), cell()) for i in range(400)] + [(400, "long\n" * 3000 + "end", "z")] + [(i, cell(), "q") for i in range(401, 450)]
    path = tmp_path / "products.csv"
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerows([("product_id", "category", "brand"), *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (path.stat().st_size // 8, 2500, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            read = read_raw(spark, str(tmp_path), "raw_products", line_breaks=True)
            assert sorted((r.product_id, r.category, r.brand) for r in read.collect()) == rows
            splits = spark.read.text(str(path)).select("_metadata.file_block_start").distinct().count()
            assert splits >= (6 if size < 1 << 27 else 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_splits_inside_a_record_know_where_it_starts():
    quotes = {("f", 0): 3, ("f", 10): 0, ("f", 20): 2, ("f", 30): 1, ("f", 40): 0, ("g", 0): 0, ("g", 10): 1}
    assert starts(quotes) == {("f", 10): 0, ("f", 20): 0, ("f", 30): 20}


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    assert usable("local[4]", "/tmp/warehouse/_staged") and usable("spark://x:7077", "hdfs://x/warehouse/_staged")
    assert not usable("spark://x:7077", "file:/tmp/warehouse/_staged") and usable("spark://x:7077", "file:///shared/checkpoints")
