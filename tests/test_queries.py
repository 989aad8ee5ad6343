"""Every registered query against DuckDB, and the counts pinned in FIXTURES.md."""

import os

import pytest

import __spark_entry__ as registry
from compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = ({k: v for k, v in x.items() if k in registry.REGISTERED} for x in (registry.queries(), registry.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) == set(registry.REGISTERED)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, ORACLE[name]) == ""


def test_entry(spark):
    df = registry.entry(spark)
    assert df.count() == 30
    assert df.columns[-1] == "is_anomaly"


PINNED = {
    "q_duplicate_orders": 15,
    "q_missing_customer": 32,
    "q_negative_total": 19,
    "quarantine_orders": 66,
    "orders_clean": 1436,
    "quarantine_payments": 79,
    "q_paid_mismatch": 42,
    "payments_clean": 1372,
    "fact_orders_full": 1436,
    "fact_orders_window": 10,
    "fact_orders_upsert": 1303,
    "insert_ignore_orders": 1514,
    "key_violations": 15,
    "dim_date": 1063,
    "dim_customer": 150,
}


@pytest.mark.parametrize("name", list(PINNED))
def test_pinned_count(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == PINNED[name]


def test_anomaly_days(spark):
    rows = QUERIES["revenue_anomalies"](spark, "/root/testdata/sf0.01").collect()
    assert [str(r.order_day) for r in rows] == ["2024-01-23", "2024-01-06"]
    logged = QUERIES["anomaly_log"](spark, "/root/testdata/sf0.01").collect()
    assert [str(r.order_day) for r in logged] == ["2024-01-23"]
