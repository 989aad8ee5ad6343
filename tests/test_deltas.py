"""Quarantine and clean tables kept up by deltas, held against the rules over all raw rows."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from test_pipeline import AS_OF, PREVIOUS, add_orders, add_payments, at, publish, small_warehouse

from tallyhouse import schemas
from tallyhouse.plans import model, reports
from tallyhouse.plans.pipeline import Settings, run_pipeline
from tallyhouse.plans.runs import tracked_run
from tallyhouse.plans.samples import EVENTS_AS_OF, Samples
from tallyhouse.sources.warehouse import Warehouse


def raw(warehouse):
    return warehouse.read("raw.orders", schemas.RAW_ORDERS), warehouse.read("raw.payments", schemas.RAW_PAYMENTS)


def expected(warehouse, mode, moment):
    orders, payments = raw(warehouse)
    bad_payments = model.quarantined_payments(payments, orders, moment)
    clean = model.clean_orders(orders, mode)
    return {
        "raw.quarantine_orders": model.quarantined_orders(orders, at=moment),
        "raw.quarantine_payments": bad_payments,
        "staging.orders_clean": clean,
        "staging.payments_clean": model.clean_payments(payments, bad_payments),
        "analytics.dim_date": model.dim_date(clean),
    }


SCHEMAS = {
    "raw.quarantine_orders": schemas.QUARANTINE_ORDERS,
    "raw.quarantine_payments": schemas.QUARANTINE_PAYMENTS,
    "staging.orders_clean": schemas.RAW_ORDERS,
    "staging.payments_clean": schemas.RAW_PAYMENTS,
    "analytics.dim_date": schemas.DIM_DATE,
}


def same_as_rebuilt(warehouse, mode, moment):
    for table, df in expected(warehouse, mode, moment).items():
        found = Counter(warehouse.newest(table, SCHEMAS[table]).collect())
        assert found == Counter(schemas.conform(df, SCHEMAS[table]).collect()), table
    row = warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).orderBy("run_timestamp").tail(1)[0]
    orders, payments = raw(warehouse)
    tables = [warehouse.newest(t, SCHEMAS[t]) for t in list(SCHEMAS)[:4]]
    counts = [df.count() for df in (orders, tables[0], tables[2], payments, tables[1], tables[3])]
    assert list(row)[2:] == counts


def random_load(spark, rng, table, n, start):
    """Rows with repeats of older keys, missing keys and references, and odd totals."""
    rows = []
    for _ in range(n):
        key = rng.choice([None, ""] + [f"O{rng.randint(1, start + 12)}"] * 18)
        moment = datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 40))
        amount = Decimal(rng.choice([-1, 5, 5, 5, 6]))
        seen = datetime(2024, 2, 1) + timedelta(hours=rng.randint(0, 99))
        if table == "raw.orders":
            rows.append((key, rng.choice([None, "", "c", "c", "c", "c"]), rng.choice([None, moment, moment, moment]), amount, seen, None, None, None))
        else:
            payment = rng.choice([None] + [f"P{rng.randint(1, start + 12)}"] * 12)
            rows.append((payment, key, rng.choice(["paid", "paid", "failed"]), amount, seen, None, None, None))
    return spark.createDataFrame(rows, schemas.RAW_ORDERS if table == "raw.orders" else schemas.RAW_PAYMENTS)


@pytest.mark.parametrize("mode, seed", [("drop_all", 1), ("keep_first", 2)])
def test_runs_after_odd_loads_equal_the_rules_over_everything(spark, tmp_path, mode, seed):
    rng, warehouse = random.Random(seed), Warehouse(spark, str(tmp_path))
    for step in range(3):
        for table, n in (("raw.orders", 12), ("raw.payments", 9)):
            if step != 1 or table == "raw.payments":  # one load brings payments only
                warehouse.append(random_load(spark, rng, table, n, 10 * step), table)
        moment = at(AS_OF, 6 + step)
        # The window lies behind all days, so odd keys do not stop the run.
        run_pipeline(warehouse, AS_OF.replace(year=2025), Settings(on_duplicate=mode), now=moment)
    same_as_rebuilt(warehouse, mode, moment)
    layers = warehouse.manifests.newest().newest_run().layers
    assert len(layers) == 3 and any(layer.touched["order_id"] for layer in layers)
    if mode == "drop_all":  # a run without new loads, and one over the limit of layers
        before = warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS).count()
        run_pipeline(warehouse, AS_OF.replace(year=2025), now=at(AS_OF, 12))
        assert warehouse.manifests.newest().newest_run().layers == layers
        run_pipeline(warehouse, AS_OF.replace(year=2025), Settings(max_layers=1), now=at(AS_OF, 13))
        assert len(warehouse.manifests.newest().newest_run().layers) == 1
        assert warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS).count() == before


def test_only_new_loads_and_those_that_may_hold_their_keys_are_read(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    add_orders(warehouse, [(f"O{i}", "c", "2024-01-30", i) for i in range(1, 9)])
    add_payments(warehouse, [(f"P{i}", f"O{i}", i) for i in range(1, 9)])
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 6))
    old = {load.parts[t].folder for load in warehouse.manifests.newest().loads for t in load.parts}
    opened, plain = [], Warehouse.read_parts

    def watched(self, table, schema, parts):
        opened.extend(part.folder for part in parts if part.rows)
        return plain(self, table, schema, parts)

    monkeypatch.setattr(Warehouse, "read_parts", watched)
    add_orders(warehouse, [(f"O{i}", "c", "2024-01-30", i) for i in range(10, 13)])
    add_payments(warehouse, [(f"P{i}", f"O{i}", i) for i in range(10, 13)])
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 7))
    assert opened and not old & set(opened)
    # An old key is looked for in the load whose range it falls into, and nowhere else.
    opened.clear()
    add_orders(warehouse, [("O3", "c", "2024-01-30", 3)])
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 8))
    newest = warehouse.manifests.newest()
    folders = [newest.loads[i].parts.get("raw.orders") for i in (0, 2, 4)]
    assert folders[0].folder in opened and folders[1].folder not in opened
    monkeypatch.undo()
    same_as_rebuilt(warehouse, "drop_all", at(AS_OF, 8))
    assert newest.newest_run().layers[-1].touched == {"order_id": 1, "payment_id": 1}


def test_layers_that_touch_nothing_are_one_scan(spark, tmp_path):
    warehouse = small_warehouse(spark, tmp_path)
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 6))
    add_orders(warehouse, [("LATER", "c", "2024-01-30", 1)])
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 7))
    plan = warehouse.newest("staging.orders_clean", schemas.RAW_ORDERS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan


def test_only_days_whose_keys_reach_the_window_are_opened(spark, tmp_path, monkeypatch):
    warehouse = small_warehouse(spark, tmp_path)
    publish(warehouse, PREVIOUS)
    opened, plain = [], Warehouse.fact_of

    def watched(self, days):
        opened.append(sorted(str(d.order_day) for d in days))
        return plain(self, days)

    monkeypatch.setattr(Warehouse, "fact_of", watched)
    # A and B are in the window. Rows without a day have the key UNDATED only, which lies behind them.
    run_pipeline(warehouse, AS_OF, now=at(AS_OF, 6))
    assert opened == [["2023-12-01", "2023-12-02"]] * 2
    opened.clear()
    add_orders(warehouse, [(f"LATER{i}", "c", "2024-02-28", 1) for i in range(3)])
    later = AS_OF.replace(month=3, day=1)
    run_pipeline(warehouse, later, now=at(later, 6))
    assert opened == [[], []]
    monkeypatch.undo()
    assert sorted(r.order_id for r in warehouse.fact().collect()) == ["A", "B", "LATER0", "LATER1", "LATER2", "OLDER", "UNDATED"]


def events_warehouse(spark, folder, path):
    s, warehouse = Samples(spark, folder), Warehouse(spark, str(path))
    with tracked_run(warehouse, 7, at(EVENTS_AS_OF)) as run:
        fact = schemas.conform(s.fact_events, schemas.FACT_ORDERS)
        warehouse.write_days_list(warehouse.write_fact_days(fact, run.run_id), run.run_id)
    return s, warehouse


def test_reports_from_daily_totals_equal_those_of_the_fact(spark, tmp_path):
    s, warehouse = events_warehouse(spark, "/root/testdata/sf0.001", tmp_path)
    totals, fact = warehouse.fact_totals(), s.fact_events
    pairs = [
        (reports.kpi_of_totals(totals), reports.kpi_summary(fact)),
        (reports.daily_revenue_of_totals(totals), reports.daily_revenue(fact)),
        (reports.orders_per_day_of_totals(totals), reports.orders_per_day(fact)),
        (reports.payment_status_of_totals(totals), reports.payment_status_dist(fact)),
        (reports.revenue_anomaly_of_totals(totals), reports.revenue_anomaly_daily(fact)),
        (
            reports.anomaly_log_of_totals(totals, EVENTS_AS_OF, 7, "R", at(EVENTS_AS_OF)),
            reports.anomaly_log(fact, EVENTS_AS_OF, 7, "R", at(EVENTS_AS_OF)),
        ),
    ]
    for mine, other in pairs:
        assert Counter(mine.collect()) == Counter(other.collect())
        assert mine.columns == other.columns
        assert "fact_orders" not in mine._jdf.queryExecution().toString()
    empty = Warehouse(spark, str(tmp_path / "none"))
    assert [tuple(r) for r in reports.kpi_of_totals(empty.fact_totals()).collect()] == [(0, 0)]
