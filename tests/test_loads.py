"""CSV ingest, lineage, first load, daily loads and arriving files."""

import os
from datetime import datetime
from decimal import Decimal

import pytest

from tallyhouse import schemas
from tallyhouse.plans.loads import bootstrap, load_daily, seed_if_empty
from tallyhouse.sources import lineage
from tallyhouse.sources.csv import read_csv, read_csv_split, write_csv
from tallyhouse.session import shared_folder
from tallyhouse.sources.warehouse import Load, Warehouse
from tallyhouse.streaming.arrivals import load_arrivals

NOW = datetime(2024, 1, 2, 3, 4, 5)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


ORDERS_HEADER = "order_id,customer_id,order_date,order_total"
PAYMENTS_HEADER = "payment_id,order_id,payment_status,payment_amount"


def test_null_and_empty_cells_differ(spark, tmp_path):
    file = write(
        tmp_path / "orders.csv",
        ORDERS_HEADER,
        "O1,,2024-01-01 10:00:00,1.235",
        'O2,"",2024-01-01 10:00:00,',
        'O3,"a ""quoted"", \\b",2024-01-01 10:00:00,-2.5',
    )
    rows = {r.order_id: r for r in read_csv(spark, file, schemas.ORDERS_CSV).collect()}
    assert rows["O1"].customer_id is None and rows["O1"].order_total == Decimal("1.24")
    assert rows["O2"].customer_id == "" and rows["O2"].order_total is None
    assert rows["O3"].customer_id == 'a "quoted", \\b' and rows["O3"].order_date == datetime(2024, 1, 1, 10)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("O1", None, datetime(2024, 1, 1), Decimal("1.00")), ("O2", "", None, None), ("O,3", 'x"y\\', None, None)],
        schemas.ORDERS_CSV,
    )
    write_csv(df, str(tmp_path / "out.csv"))
    assert set(read_csv(spark, str(tmp_path / "out.csv"), schemas.ORDERS_CSV).collect()) == set(df.collect())


def test_cells_as_a_bulk_copy_reads_them(spark, tmp_path):
    file = write(
        tmp_path / "customers.csv",
        "customer_id,name,email,city,created_at",
        'C1,"two\nlines, ""quoted""",\\N,  Rome ,2024-01-01 00:00:00',
        "C2, padded ,,\"\",",
    )
    rows = {r.customer_id: r for r in read_csv(spark, file, schemas.CUSTOMERS_CSV, multiline=True).collect()}
    assert (rows["C1"].name, rows["C1"].email, rows["C1"].city) == ('two\nlines, "quoted"', "\\N", "  Rome ")
    assert (rows["C2"].name, rows["C2"].email, rows["C2"].city, rows["C2"].created_at) == (" padded ", None, "", None)


def test_round_trip_keeps_blanks(spark, tmp_path):
    df = spark.createDataFrame([("  x ", " ", "", None, None), ("\\N", "\ta\t", None, "", None)], schemas.CUSTOMERS_CSV)
    write_csv(df, str(tmp_path / "out.csv"))
    assert set(read_csv(spark, str(tmp_path / "out.csv"), schemas.CUSTOMERS_CSV).collect()) == set(df.collect())


def test_bad_cell_fails_or_is_set_aside(spark, tmp_path):
    file = write(tmp_path / "o.csv", ORDERS_HEADER, "O1,c,2024-01-01 10:00:00,abc", "O2,c,2024-01-01 10:00:00,1")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, file, schemas.ORDERS_CSV).collect()
    good, bad = read_csv_split(spark, file, schemas.ORDERS_CSV)
    assert [r.order_id for r in good.collect()] == ["O2"]
    assert [r._corrupt_record for r in bad.collect()] == ["O1,c,2024-01-01 10:00:00,abc"]


def test_too_large_a_value_or_too_long_an_id_fails(spark, tmp_path):
    large = write(tmp_path / "large.csv", ORDERS_HEADER, "O1,c,2024-01-01 10:00:00,123456789.00")
    with pytest.raises(Exception):
        read_csv(spark, large, schemas.ORDERS_CSV).collect()
    ids = spark.createDataFrame([("x" * 50, None)], "order_id string, customer_id string")
    assert schemas.limit_ids(ids).count() == 1
    with pytest.raises(Exception, match="order_id is longer than 50"):
        schemas.limit_ids(ids.selectExpr("order_id || 'y' AS order_id", "customer_id")).collect()


def test_tag_fills_only_untagged_rows(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("b", "old.csv", "OLD"), ("c", None, "x")], "k string, source_file string, batch_id string"
    )
    rows = {r.k: (r.source_file, r.batch_id) for r in lineage.tag(df, "new.csv", "NEW").collect()}
    assert rows == {"a": ("new.csv", "NEW"), "b": ("old.csv", "OLD"), "c": ("new.csv", "NEW")}


def test_seed_if_empty(spark):
    full, empty = spark.range(3), spark.range(0)
    assert seed_if_empty(empty, full).count() == 3
    assert seed_if_empty(full, spark.range(7)).count() == 3


@pytest.fixture
def base_files(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    write(folder / "customers.csv", "customer_id,name,email,city,created_at", "C1, Ann ,a@example.net,Rome,2024-01-01 00:00:00", "C9,   ,,,")
    write(folder / "products.csv", "product_id,product_name,category,price", "P1,Cup,home,3.50")
    write(folder / "orders.csv", ORDERS_HEADER, "O1,C1,2024-01-01 10:00:00,5.00", "O1,C1,2024-01-01 10:00:00,5.00", "O2,C1,2024-01-02 10:00:00,6.00")
    write(folder / "payments.csv", PAYMENTS_HEADER, "Y1,O1,paid,5.00", "Y2,O2,paid,6.00")
    return str(folder)


def test_first_load_and_daily_load(spark, tmp_path, base_files):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert bootstrap(warehouse, base_files, NOW) == ["raw.customers", "raw.products", "raw.orders", "raw.payments"]
    assert bootstrap(warehouse, base_files, NOW) == []
    orders = warehouse.read("raw.orders", schemas.RAW_ORDERS)
    assert orders.count() == 3
    first = orders.first()
    assert (first.source_file, first.batch_id, first.ingested_at) == ("orders.csv", "BOOTSTRAP", NOW)
    assert all(r.run_id for r in orders.collect())

    orders_csv = write(tmp_path / "orders_daily.csv", ORDERS_HEADER, "O2,C9,2024-01-03 00:00:00,1", "O3,C1,2024-01-03 00:00:00,2")
    payments_csv = write(tmp_path / "payments_daily.csv", PAYMENTS_HEADER, "Y2,O2,failed,0", "Y3,O3,paid,2")
    for _ in range(2):
        load_daily(warehouse, orders_csv, payments_csv, NOW, run_id="LOAD_1")
        rows = warehouse.read("raw.orders", schemas.RAW_ORDERS).collect()
        assert sorted(r.order_id for r in rows) == ["O1", "O1", "O2", "O3"]
        added = next(r for r in rows if r.order_id == "O3")
        assert (added.source_file, added.batch_id, added.run_id) == ("orders_daily.csv", "BATCH_DAILY", "LOAD_1")
        payments = {r.payment_id: r.payment_status for r in warehouse.read("raw.payments", schemas.RAW_PAYMENTS).collect()}
        assert payments == {"Y1": "paid", "Y2": "paid", "Y3": "paid"}


def test_daily_load_needs_both_files(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    orders_csv = write(tmp_path / "orders_daily.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2")
    with pytest.raises(FileNotFoundError):
        load_daily(warehouse, orders_csv, str(tmp_path / "missing.csv"), NOW)
    assert warehouse.read("raw.orders", schemas.RAW_ORDERS).isEmpty()


def test_bad_payment_file_leaves_the_orders_alone(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    orders_csv = write(tmp_path / "orders_daily.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2")
    payments_csv = write(tmp_path / "payments_daily.csv", PAYMENTS_HEADER, "Y3,O3,paid,two")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_daily(warehouse, orders_csv, payments_csv, NOW)
    assert warehouse.read("raw.orders", schemas.RAW_ORDERS).isEmpty()


def test_both_tables_grow_together_or_neither(spark, tmp_path, base_files, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    bootstrap(warehouse, base_files, NOW)
    orders_csv = write(tmp_path / "o.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2")
    payments_csv = write(tmp_path / "p.csv", PAYMENTS_HEADER, "Y3,O3,paid,2")
    plain = Load.append

    def failing(self, df, table, *more):
        plain(self, df, table, *more)
        if table == "raw.payments":
            raise RuntimeError("lost")

    monkeypatch.setattr(Load, "append", failing)
    with pytest.raises(RuntimeError):
        load_daily(warehouse, orders_csv, payments_csv, NOW)
    monkeypatch.undo()
    counts = lambda: (warehouse.read("raw.orders", schemas.RAW_ORDERS).count(), warehouse.read("raw.payments", schemas.RAW_PAYMENTS).count())
    assert counts() == (3, 2) and len(warehouse._folders(warehouse.path("raw.orders"))) == 1
    load_daily(warehouse, orders_csv, payments_csv, NOW)
    assert counts() == (4, 3)


def test_bad_lines_are_set_aside_on_request(spark, tmp_path, base_files):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    bootstrap(warehouse, base_files, NOW)
    orders_csv = write(tmp_path / "o.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2", "O4,C1,2024-01-03 00:00:00,two")
    payments_csv = write(tmp_path / "p.csv", PAYMENTS_HEADER, "Y3,O3,paid,2")
    load_daily(warehouse, orders_csv, payments_csv, NOW, set_aside=True)
    assert warehouse.read("raw.orders", schemas.RAW_ORDERS).count() == 4
    bad = spark.read.parquet(warehouse.path("raw.orders_rejected")).collect()
    assert [(r.line, r.source_file) for r in bad] == [("O4,C1,2024-01-03 00:00:00,two", "o.csv")]


def test_loads_leave_nothing_in_the_shared_folder(spark, tmp_path, base_files):
    before = set(os.listdir(shared_folder(spark)))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    bootstrap(warehouse, base_files, NOW)
    orders_csv = write(tmp_path / "o.csv", ORDERS_HEADER, "O3,C1,2024-01-03 00:00:00,2")
    payments_csv = write(tmp_path / "p.csv", PAYMENTS_HEADER, "Y3,O3,paid,2")
    for _ in range(2):
        load_daily(warehouse, orders_csv, payments_csv, NOW)
    assert set(os.listdir(shared_folder(spark))) == before


def test_arriving_files_are_loaded_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    landing = tmp_path / "landing"
    landing.mkdir()
    arguments = (warehouse, "raw.orders", str(landing), str(tmp_path / "checkpoint"))
    write(landing / "day1.csv", ORDERS_HEADER, "O1,C1,2024-01-01 00:00:00,1", "O1,C1,2024-01-01 00:00:00,1")
    load_arrivals(*arguments).awaitTermination()
    write(landing / "day2.csv", ORDERS_HEADER, "O1,C2,2024-01-02 00:00:00,9", "O2,C2,2024-01-02 00:00:00,2")
    load_arrivals(*arguments).awaitTermination()
    load_arrivals(*arguments).awaitTermination()
    rows = warehouse.read("raw.orders", schemas.RAW_ORDERS).collect()
    assert sorted((r.order_id, r.source_file, r.batch_id) for r in rows) == [
        ("O1", "day1.csv", "BATCH_DAILY"),
        ("O2", "day2.csv", "BATCH_DAILY"),
    ]
