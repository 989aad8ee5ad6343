"""Trailing statistics, anomaly rules, reports and contracts on small tables."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from tallyhouse import schemas
from tallyhouse.operators import contracts
from tallyhouse.operators.trends import AnomalyRule, recent_history, scored_days, trailing_zscore
from tallyhouse.plans import reports

FACT = schemas.FACT_ORDERS


def daily_fact(spark, revenue_by_day, orders=20):
    rows = []
    for day, revenue in revenue_by_day:
        rows.append((f"{day}-0", "c", day, Decimal(revenue), "paid", Decimal(revenue)))
        rows += [(f"{day}-{i}", "c", day, Decimal(0), "failed", Decimal(0)) for i in range(1, orders)]
    return spark.createDataFrame(rows, FACT)


START = date(2024, 1, 1)


def days_from(values, start=START, step=1):
    return [(start + timedelta(days=i * step), value) for i, value in enumerate(values)]


def test_frame_is_prior_rows_not_days(spark):
    series = spark.createDataFrame([(START, 10), (date(2024, 3, 1), 20), (date(2024, 9, 1), 40)], "d date, v int")
    rows = trailing_zscore(series, "d", "v", rows=2).orderBy("d").collect()
    assert [r.avg_prior for r in rows] == [None, 10.0, 15.0]
    assert rows[1].std_prior is None and rows[1].z is None and rows[1].pct_change == 1.0
    assert rows[2].z == pytest.approx(25 / 7.0710678)


def test_zero_average_or_deviation_gives_null(spark):
    series = spark.createDataFrame([(i, 0) for i in range(3)] + [(3, 5)], "d int, v int")
    last = trailing_zscore(series, "d", "v").orderBy("d").collect()[-1]
    assert last.pct_change is None and last.z is None


def test_statistics_per_series(spark):
    series = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 100.0)], "s string, d int, v double")
    rows = {(r.s, r.d): r.avg_prior for r in trailing_zscore(series, "d", "v", partition_by=["s"]).collect()}
    assert rows == {("a", 1): None, ("a", 2): 1.0, ("b", 1): None}


def test_null_day_does_not_enter_the_frame_of_real_days(spark):
    fact = daily_fact(spark, days_from([100, 110])).unionByName(
        spark.createDataFrame([("x", "c", None, Decimal(9), "paid", Decimal(9))], FACT)
    )
    scores = {r.order_day: r.avg_prior for r in scored_days(fact).collect()}
    assert scores[START] is None and scores[START + timedelta(days=1)] == 100.0


def test_thresholds(spark):
    base = [100, 102] * 7
    fact = daily_fact(spark, days_from([*base, 200]))
    assert [r.is_anomaly for r in reports.revenue_anomaly_daily(fact).orderBy("order_day").collect()] == [False] * 14 + [True]
    assert reports.revenue_anomalies(daily_fact(spark, days_from([*base, 200]), orders=14)).isEmpty()
    assert reports.revenue_anomalies(daily_fact(spark, days_from([*base, 120]))).isEmpty()
    assert reports.revenue_anomalies(fact, AnomalyRule(above_z=1000)).isEmpty()


def test_log_covers_the_window_only_and_uses_history_before_it(spark):
    values = [100, 102] * 10 + [200] + [101] * 20
    fact = daily_fact(spark, days_from(values, step=3))
    hit = START + timedelta(days=60)
    log = reports.anomaly_log(fact, hit + timedelta(days=7), 7, "RUN", datetime(2024, 6, 1))
    row = log.first()
    assert (row.run_id, row.order_day, row.revenue, row.orders) == ("RUN", hit, Decimal("200.00"), 20)
    assert row.rev_avg_14d == Decimal("101.00") and row.detected_at == datetime(2024, 6, 1)
    assert log.schema == schemas.ANOMALY_LOG or [f.dataType for f in log.schema] == [f.dataType for f in schemas.ANOMALY_LOG]
    assert reports.anomaly_log(fact, hit + timedelta(days=8), 7, "RUN", datetime(2024, 6, 1)).isEmpty()


def test_recent_history_is_the_window_and_the_rows_before(spark):
    fact = daily_fact(spark, days_from([1] * 40, step=2), orders=1)
    as_of = START + timedelta(days=78)
    found = sorted(r.order_day for r in recent_history(fact, as_of, 7).collect())
    assert found[0] == START + timedelta(days=2 * (40 - 4 - 14)) and len(found) == 18
    assert recent_history(fact, START, 7).count() == 40


def test_reports_on_an_empty_fact(spark):
    empty = spark.createDataFrame([], FACT)
    assert tuple(reports.kpi_summary(empty).first()) == (0, Decimal("0.00"))
    assert reports.daily_revenue(empty).isEmpty() and reports.revenue_anomalies(empty).isEmpty()


def test_top_cities_counts_a_missing_city_and_puts_null_first(spark):
    fact = spark.createDataFrame(
        [("1", "a", START, Decimal("5.25"), None, None), ("2", "a", START, Decimal("1"), None, None)]
        + [("3", "b", START, Decimal("9"), None, None), ("4", "n", START, None, None, None)]
        + [("5", "lost", START, Decimal("99"), None, None)],
        FACT,
    )
    dim = spark.createDataFrame([("a", "Rome"), ("b", None), ("n", "Oslo")], "customer_id string, city string")
    rows = [(r.city, r.revenue) for r in reports.top_cities(fact, dim).collect()]
    assert rows == [("Oslo", None), (None, Decimal("9.00")), ("Rome", Decimal("6.25"))]
    assert len(reports.top_cities(fact, dim, limit=1).collect()) == 1


def test_payment_status_unknown(spark):
    fact = spark.createDataFrame([("1", "a", START, None, None, None), ("2", "a", START, None, "paid", None)], FACT)
    rows = {r["payment_status"]: r["count"] for r in reports.payment_status_dist(fact).collect()}
    assert rows == {"unknown": 1, "paid": 1}


def metrics(spark, *rows):
    return spark.createDataFrame(
        [(datetime(2024, 1, day), 7, 100, 2, 98, raw, bad, raw - bad) for day, raw, bad in rows],
        schemas.PIPELINE_METRICS,
    )


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, 100, 90), (2, 100, 5)], [("PASS", 5)]),
        ([(1, 100, 5), (2, 100, 6)], [("FAIL", 6)]),
        ([(1, 0, 0)], [("FAIL", 0)]),
        ([], []),
    ],
)
def test_quarantine_rate_contract(spark, rows, expected):
    found = contracts.quarantine_rate_at_most(metrics(spark, *rows), 0.05, "rate").collect()
    assert [(r.status, r.failing_rows) for r in found] == expected


def test_metrics_trend(spark):
    trend = reports.metrics_trend(metrics(spark, (2, 0, 0), (1, 300, 10))).collect()
    assert [r.payments_quarantine_pct for r in trend] == [3.33, None]
    assert [r.orders_quarantine_pct for r in trend] == [2.0, 2.0]


def test_all_contracts_run_before_failing(spark):
    fact = daily_fact(spark, days_from([1]), orders=2)
    log = spark.createDataFrame([], schemas.ANOMALY_LOG)
    good = contracts.warehouse_contracts(fact, metrics(spark, (1, 100, 1)), log)
    assert {status for _, status, _ in contracts.run_contracts(good)} == {"PASS"}
    doubled = fact.unionByName(fact).unionByName(
        spark.createDataFrame([(None, "c", START, None, None, None)], FACT)
    )
    with pytest.raises(contracts.ContractsFailed) as failure:
        contracts.run_contracts(contracts.warehouse_contracts(doubled, metrics(spark, (1, 10, 9)), log))
    for name in ("duplicate_order_id: 2", "null_order_id: 1", "quarantine_rate: 9"):
        assert name in str(failure.value)
    assert "recent_anomalies" not in str(failure.value)
    assert len(failure.value.results) == 4


def test_more_than_five_anomalies_fail(spark):
    assert contracts.anomalies_at_most(spark.range(5), 5, "n").first()["status"] == "PASS"
    assert contracts.anomalies_at_most(spark.range(6), 5, "n").first()["status"] == "FAIL"


def test_contracts_from_a_file(spark, tmp_path):
    path = tmp_path / "contracts.sql"
    path.write_text("""
-- two checks; this note ends in a semicolon;
SELECT 'a;b' AS check_name, 'PASS' AS status, count(*) AS failing_rows
FROM {some} WHERE v > 9;
SELECT 'bad' AS check_name, 'FAIL' AS status, count(*) AS failing_rows FROM {some};

SELECT 'none' AS check_name, 'FAIL' AS status, 1 AS failing_rows FROM {some} WHERE false""")
    tables = {"some": spark.range(3).withColumnRenamed("id", "v"), "other": spark.range(1)}
    checks = contracts.file_contracts(spark, str(path), tables)
    assert sorted(tuple(r) for c in checks for r in c.collect()) == [("a;b", "PASS", 0), ("bad", "FAIL", 3)]
    with pytest.raises(contracts.ContractsFailed, match="bad: 3"):
        contracts.run_contracts(checks)
    assert contracts.run_contracts(checks[:1]) == [("a;b", "PASS", 0)] and contracts.run_contracts([]) == []
    path.write_text("SELECT 1 AS check_name;")
    with pytest.raises(ValueError, match="a contract returns"):
        contracts.file_contracts(spark, str(path), tables)
    path.write_text("SELECT 'x' AS check_name, 'MAYBE' AS status, 1 AS failing_rows;")
    with pytest.raises(Exception, match="MAYBE"):
        contracts.run_contracts(contracts.file_contracts(spark, str(path), tables))
