"""The batch pipeline: quarantine, clean tables, gate, fact, dimensions, anomalies, metrics."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame

from tallyhouse import schemas
from tallyhouse.functions import cutoff
from tallyhouse.operators.contracts import file_contracts, run_contracts, warehouse_contracts
from tallyhouse.operators.keys import assert_key
from tallyhouse.operators.merge import moved_days, rebuilt_days
from tallyhouse.operators.quality import check_gate
from tallyhouse.operators.trends import AnomalyRule
from tallyhouse.plans import deltas, model, reports
from tallyhouse.plans.runs import metrics_row, tracked_run
from tallyhouse.schemas import conform
from tallyhouse.sources.manifests import RunEntry, overlap
from tallyhouse.sources.warehouse import FACT_DAYS, Warehouse


RAW = {
    "raw.orders": schemas.RAW_ORDERS,
    "raw.payments": schemas.RAW_PAYMENTS,
    "raw.customers": schemas.RAW_CUSTOMERS,
    "raw.products": schemas.RAW_PRODUCTS,
}
NEWEST = {
    "raw.quarantine_orders": schemas.QUARANTINE_ORDERS,
    "raw.quarantine_payments": schemas.QUARANTINE_PAYMENTS,
    "staging.orders_clean": schemas.RAW_ORDERS,
    "staging.payments_clean": schemas.RAW_PAYMENTS,
    "analytics.dim_customer": schemas.DIM_CUSTOMER,
    "analytics.dim_product": schemas.DIM_PRODUCT,
    "analytics.dim_date": schemas.DIM_DATE,
}
LOGGED = {"analytics.pipeline_metrics": schemas.PIPELINE_METRICS, "analytics.revenue_anomaly_log": schemas.ANOMALY_LOG}


@dataclass(frozen=True)
class Settings:
    window_days: int = 7
    max_errors: int = 999_999
    keep_runs: int | None = 1
    on_duplicate: str = "drop_all"
    max_layers: int = 16
    anomaly: AnomalyRule = field(default_factory=AnomalyRule)


def run_pipeline(
    warehouse: Warehouse, as_of: date | None = None, settings: Settings = Settings(), now: datetime | None = None
) -> str:
    """Run the pipeline once over the raw layer and return the run id.

    ``as_of`` and ``now`` are taken once, so every step of the run sees the same day. The run sees the loads that were committed
    when it began. Quarantine and clean tables gain a layer for the loads that are new since the last run; the first run, one with
    another setting, and one after ``max_layers`` of them makes one layer of all. Only ``keep_runs`` runs keep their outputs, all
    do with None; logs keep every run.
    """
    now = now or datetime.now()
    as_of = as_of or now.date()
    days, key = settings.window_days, ["order_id"]

    with tracked_run(warehouse, days, now) as run:

        def keep(df, table):
            return warehouse.write_run(df, table, run.run_id)

        refined = deltas.refine(warehouse, run, settings.on_duplicate, settings.max_layers)
        run.covers, run.mode, run.layers, run.counts = len(run.base.loads), settings.on_duplicate, refined.layers, refined.counts
        keep(metrics_row(warehouse.spark, days, now, run.counts), "analytics.pipeline_metrics")
        check_gate({name: run.counts[name] for name in ("quarantined_orders", "quarantined_payments")}, settings.max_errors)

        # Window of the fact, checked before anything is published.
        placed = keep(model.placed_orders(refined.orders, as_of, days), "work.window_orders")
        window = model.with_payments(placed, model.payments_of(placed, refined.payments))
        window, counted = warehouse.write_counted(window, "work.fact_window", run.run_id, key)
        assert_key(window, key, "the fact window")

        # Dimensions.
        customers = warehouse.read("raw.customers", schemas.RAW_CUSTOMERS, run.base.loads)
        products = warehouse.read("raw.products", schemas.RAW_PRODUCTS, run.base.loads)
        keep(model.dim_customer(customers), "analytics.dim_customer")
        keep(model.dim_product(products), "analytics.dim_product")
        keep(model.dim_date(refined.order_days), "analytics.dim_date")

        def publish(base: RunEntry | None) -> None:
            """The days of the fact that change, written beside the old ones, and the anomalies of the fact as it will be."""
            before, start = warehouse.fact_days(base) if base else [], cutoff(as_of, days)
            # Only days whose range of keys reaches into that of the window can lose a row to it.
            opened = [d for d in before if (d.order_day is None or d.order_day < start) and overlap(d.keys, counted.ranges["order_id"])]
            moved = moved_days(warehouse.fact_of(opened), window, key, "order_day", as_of, days)
            affected = warehouse.fact_of([d for d in opened if d.order_day in moved])
            changed = conform(rebuilt_days(affected, window, key, "order_day", as_of, days, moved, checked=True), schemas.FACT_ORDERS)
            filled = warehouse.write_fact_days(changed, run.run_id)
            replaced = moved | {d.order_day for d in filled}
            stale = {d.order_day for d in before if d.order_day is not None and d.order_day >= start} | replaced
            after = [d for d in before if d.order_day not in stale] + filled
            warehouse.write_days_list(after, run.run_id)
            totals = warehouse.newest(FACT_DAYS, schemas.FACT_DAYS, RunEntry(run.run_id, now, now, days))
            log = reports.anomaly_log_of_totals(totals, as_of, days, run.run_id, now, settings.anomaly)
            keep(log.drop("run_id"), "analytics.revenue_anomaly_log")

        publish(run.base.newest_run())
        run.rebase = publish
    if settings.keep_runs is not None:
        warehouse.drop_old_runs(settings.keep_runs)
    return run.run_id


def published_contracts(warehouse: Warehouse) -> list[DataFrame]:
    """The contracts on the published tables, one row each."""
    return warehouse_contracts(
        warehouse.fact(),
        warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS),
        warehouse.log("analytics.revenue_anomaly_log", schemas.ANOMALY_LOG),
    )


def published_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    """All tables of a warehouse by the name that contract files call them."""
    found = {name.split(".")[1]: warehouse.newest(name, schema) for name, schema in NEWEST.items()}
    raw = {name.replace(".", "_"): warehouse.read(name, schema) for name, schema in RAW.items()}
    logs = {name.split(".")[1]: warehouse.log(name, schema) for name, schema in LOGGED.items()}
    return found | raw | logs | {"fact_orders": warehouse.fact(), "fact_totals": warehouse.fact_totals(), "pipeline_runs": warehouse.runs()}


def check_warehouse(warehouse: Warehouse, file: str | None = None) -> list[tuple[str, str, int]]:
    """Run the contracts on the published tables, or those of a file; raise if one fails."""
    if file is None:
        return run_contracts(published_contracts(warehouse))
    return run_contracts(file_contracts(warehouse.spark, file, published_tables(warehouse)))
