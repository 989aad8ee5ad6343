"""Whole pipeline runs: results, repeatability, failures and run records."""

import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators.contracts import ContractsFailed
from tallyhouse.operators.keys import KeyViolation
from tallyhouse.operators.quality import QualityGateBreached
from tallyhouse.operators.trends import AnomalyRule
from tallyhouse.plans import reports
from tallyhouse.plans.pipeline import Settings, check_warehouse, run_pipeline
from tallyhouse.plans.runs import tracked_run
from tallyhouse.plans.samples import ORDERS_AS_OF, Samples
from tallyhouse.schemas import conform
from tallyhouse.session import shared_folder
from tallyhouse.sources.manifests import Manifests
from tallyhouse.sources.warehouse import REBUILT, Warehouse


def at(day, hour=6):
    return datetime(day.year, day.month, day.day, hour)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    s = Samples(spark, "/root/testdata/sf0.001")
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("wh")))
    for table, df, schema in (
        ("raw.orders", s.raw_orders, schemas.RAW_ORDERS),
        ("raw.payments", s.raw_payments, schemas.RAW_PAYMENTS),
        ("raw.customers", s.raw_customers, schemas.RAW_CUSTOMERS),
        ("raw.products", s.raw_products, schemas.RAW_PRODUCTS),
    ):
        warehouse.append(conform(df, schema), table)
    return warehouse, s


def test_runs_over_time(loaded):
    warehouse, s = loaded
    # A first run over all history, then a later one over a week.
    first = run_pipeline(warehouse, date(2001, 7, 28), Settings(window_days=4000), now=at(date(2001, 7, 28)))
    full = Counter(conform(s.fact_full, schemas.FACT_ORDERS).collect())
    assert Counter(warehouse.fact().collect()) == full

    second = run_pipeline(warehouse, ORDERS_AS_OF, now=at(ORDERS_AS_OF))
    assert Counter(warehouse.fact().collect()) == full

    assert warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS).count() == 1436
    assert warehouse.newest("analytics.dim_date", schemas.DIM_DATE).count() == 1063
    assert warehouse.newest("analytics.dim_customer", schemas.DIM_CUSTOMER).filter("name IS NOT NULL").count() == 146
    assert warehouse.newest("analytics.dim_product", schemas.DIM_PRODUCT).count() == 200
    bad = warehouse.newest("raw.quarantine_orders", schemas.QUARANTINE_ORDERS)
    assert bad.count() == 66 and bad.select("quarantined_at").distinct().first()[0] == at(ORDERS_AS_OF)

    metrics = warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).orderBy("run_timestamp").collect()
    assert [tuple(m)[1:] for m in metrics] == [(4000, 1515, 66, 1436, 1451, 79, 1372), (7, 1515, 66, 1436, 1451, 79, 1372)]
    runs = {r.run_id: (r.status, r.window_days, r.notes) for r in warehouse.runs().collect()}
    assert runs == {first: ("success", 4000, None), second: ("success", 7, None)}
    with pytest.raises(ContractsFailed, match="payments_quarantine_rate: 79"):
        check_warehouse(warehouse)


def small_warehouse(spark, path):
    warehouse = Warehouse(spark, str(path))
    add_orders(warehouse, [("A", "a", "2024-01-30", 10), ("B", "b", "2024-01-29", 20), ("OLD", "a", "2024-01-01", 5)])
    add_payments(warehouse, [("pA", "A", 10), ("pB", "B", 20)])
    return warehouse


def add_orders(warehouse, rows):
    data = [(o, c, datetime.fromisoformat(d), Decimal(t), datetime(2024, 2, 1), None, None, None) for o, c, d, t in rows]
    warehouse.append(warehouse.spark.createDataFrame(data, schemas.RAW_ORDERS), "raw.orders")


def add_payments(warehouse, rows):
    data = [(p, o, "paid", Decimal(a), datetime(2024, 2, 1), None, None, None) for p, o, a in rows]
    warehouse.append(warehouse.spark.createDataFrame(data, schemas.RAW_PAYMENTS), "raw.payments")


AS_OF = date(2024, 1, 31)


def fact_rows(warehouse):
    return {(r.order_id, str(r.order_day), r.payment_status) for r in warehouse.fact().collect()}


def test_first_run_loads_the_window_only_and_without_payment_stays_null(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    add_orders(warehouse, [("C", "c", "2024-01-24", 1), ("D", "d", "2024-01-23", 1)])
    run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    assert fact_rows(warehouse) == {
        ("A", "2024-01-30", "paid"),
        ("B", "2024-01-29", "paid"),
        ("C", "2024-01-24", None),
    }


PREVIOUS = [
    ("OLDER", "a", date(2023, 12, 1), Decimal(1), "paid", Decimal(1)),
    ("A", "a", date(2023, 12, 1), Decimal(1), "paid", Decimal(1)),
    ("B", "b", date(2023, 12, 2), Decimal(1), "paid", Decimal(1)),
    ("GONE", "b", date(2024, 1, 26), Decimal(1), "paid", Decimal(1)),
    ("UNDATED", "b", None, Decimal(1), "paid", Decimal(1)),
]


def publish(warehouse, rows, hour=1):
    """Publish a fact as an earlier run would have."""
    with tracked_run(warehouse, 7, at(AS_OF, hour)) as run:
        filled = warehouse.write_fact_days(warehouse.spark.createDataFrame(rows, schemas.FACT_ORDERS), run.run_id)
        warehouse.write_days_list(filled, run.run_id)
    return run.run_id


def test_days_left_empty_disappear_and_rows_move(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    old = publish(warehouse, PREVIOUS)
    for hour in (6, 7):
        run_pipeline(warehouse, AS_OF, now=at(AS_OF, hour))
        assert fact_rows(warehouse) == {
            ("OLDER", "2023-12-01", "paid"),
            ("A", "2024-01-30", "paid"),
            ("B", "2024-01-29", "paid"),
            ("UNDATED", "None", "paid"),
        }
        assert len(warehouse.fact_days()) == 4
    # Of the old run only the day that no later run wrote is left.
    assert warehouse._folders(warehouse.path("analytics.fact_orders", old)) == ["order_day=__HIVE_DEFAULT_PARTITION__"]


STEPS = [
    (Warehouse, "write_fact_days", True),
    (Warehouse, "write_days_list", True),
    (reports, "anomaly_log_of_totals", False),
    (Manifests, "put", False),
]


@pytest.mark.parametrize("owner, step, after", STEPS)
def test_a_run_that_fails_while_publishing_changes_nothing(spark, tmp_path, monkeypatch, owner, step, after):
    """Also not once the window has moved on: the next run starts from what the last good one left."""
    warehouse = small_warehouse(spark, tmp_path)
    publish(warehouse, PREVIOUS)
    before = fact_rows(warehouse)
    plain = getattr(owner, step)

    def failing(*arguments, **named):
        if after:
            plain(*arguments, **named)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(RuntimeError):
        run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    monkeypatch.undo()
    assert fact_rows(warehouse) == before
    assert Counter(r.status for r in warehouse.runs().collect()) == {"success": 1, "failed": 1}

    later = date(2024, 2, 15)  # A and B are no longer in the window
    run_pipeline(warehouse, later, now=at(later))
    assert fact_rows(warehouse) == before
    ids = [r.order_id for r in warehouse.fact().collect()]
    assert len(ids) == len(set(ids))


def test_a_longer_window_moves_what_an_earlier_failure_left(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    publish(warehouse, PREVIOUS)
    run_pipeline(warehouse, date(2024, 2, 15), Settings(window_days=30), now=at(date(2024, 2, 15)))
    assert ("A", "2024-01-30", "paid") in fact_rows(warehouse) and ("A", "2023-12-01", "paid") not in fact_rows(warehouse)


def test_failed_run_keeps_its_whole_message(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    with pytest.raises(RuntimeError):
        with tracked_run(warehouse, 7):
            raise RuntimeError("x" * 5000)
    assert [len(r.notes) for r in warehouse.runs().collect()] == [5000]


def test_runs_leave_one_copy_of_each_table_and_an_empty_shared_folder(spark, tmp_path):
    shared = set(os.listdir(shared_folder(spark)))
    warehouse = small_warehouse(spark, tmp_path)
    for hour in (6, 7):
        run_pipeline(warehouse, AS_OF, now=at(AS_OF, hour))
    with pytest.raises(QualityGateBreached):
        add_orders(warehouse, [("X", "", "2024-01-30", 1)])
        run_pipeline(warehouse, AS_OF, Settings(max_errors=0), now=at(AS_OF, 8))
    last = run_pipeline(warehouse, AS_OF, now=at(AS_OF, 9))
    for table in REBUILT:
        assert warehouse._folders(warehouse.path(table)) == [f"run_id={last}"], table
    assert len(warehouse._folders(warehouse.path("analytics.pipeline_metrics"))) == 3
    assert set(os.listdir(shared_folder(spark))) == shared


def test_a_run_starts_few_jobs(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 7))
    assert jobs() - before <= 45


def test_anomaly_log_grows_with_every_run(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    add_orders(warehouse, [(f"N{i}", "a", f"2024-01-{i:02d}", 10 + i % 2) for i in range(24, 29)])
    add_payments(warehouse, [(f"pN{i}", f"N{i}", 10 + i % 2) for i in range(24, 29)])
    settings = Settings(anomaly=AnomalyRule(min_orders=1))
    for hour in (6, 7):
        run_pipeline(warehouse, AS_OF, settings, now=at(AS_OF, hour))
    log = warehouse.log("analytics.revenue_anomaly_log", schemas.ANOMALY_LOG)
    days = Counter(str(r.order_day) for r in log.collect())
    assert days == {"2024-01-29": 2}
    assert log.select("run_id").distinct().count() == 2


def test_gate_stops_the_run_and_leaves_the_old_state(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    before = fact_rows(warehouse)
    add_orders(warehouse, [("X", "", "2024-01-30", 1), ("Y", "y", "2024-01-30", 1)])
    with pytest.raises(QualityGateBreached):
        run_pipeline(warehouse, AS_OF, Settings(max_errors=0), now=at(AS_OF, 7))
    assert fact_rows(warehouse) == before
    assert warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS).count() == 3
    assert warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).count() == 1
    statuses = {r.status: r for r in warehouse.runs().collect()}
    assert set(statuses) == {"success", "failed"}
    assert "quality gate breached" in statuses["failed"].notes and statuses["failed"].finished_at is not None

    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 8))
    assert ("Y", "2024-01-30", None) in fact_rows(warehouse)


def test_two_payments_for_one_order_fail_the_run(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    add_payments(warehouse, [("pA2", "A", 10)])
    with pytest.raises(KeyViolation):
        run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    assert warehouse.fact().isEmpty()


def test_old_runs_are_kept_on_request(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    first = run_pipeline(warehouse, AS_OF, Settings(keep_runs=None), now=at(AS_OF))
    second = run_pipeline(warehouse, AS_OF, Settings(keep_runs=2), now=at(AS_OF, 7))
    assert all(warehouse.exists(warehouse.path("analytics.dim_date", run)) for run in (first, second))
    warehouse.drop_old_runs(1)
    assert not warehouse.exists(warehouse.path("analytics.dim_date", first))
    # The second run saw no new load, so its clean tables are the first run's layer.
    assert warehouse._folders(warehouse.path("staging.orders_clean")) == [f"run_id={first}"]
    third = run_pipeline(warehouse, AS_OF, Settings(max_layers=1), now=at(AS_OF, 8))
    assert warehouse._folders(warehouse.path("staging.orders_clean")) == [f"run_id={third}"]
    assert warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS).count() == 3
    assert warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).count() == 3
    with pytest.raises(ValueError):
        warehouse.drop_old_runs(0)


def test_run_without_any_order_publishes_an_empty_fact(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_pipeline(warehouse, AS_OF, now=at(AS_OF))
    assert warehouse.fact().isEmpty()
    metrics = warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).collect()
    assert [tuple(m)[2:] for m in metrics] == [(0, 0, 0, 0, 0, 0)]


def test_order_without_id_fails_the_run(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    add_orders(warehouse, [(None, "a", "2024-01-30", 1)])
    with pytest.raises(KeyViolation):
        run_pipeline(warehouse, AS_OF, now=at(AS_OF))


def test_fact_is_partitioned_and_pruned_by_day(loaded):
    warehouse, _ = loaded
    recent = warehouse.fact().filter(F.col("order_day") >= F.lit(date(2001, 7, 25)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_day" in plan
