
from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tallyhouse import schemas  # noqa: E402
from tallyhouse.operators import contracts, keys, merge, quality, trends  # noqa: E402
from tallyhouse.plans import loads, model, reports  # noqa: E402
from tallyhouse.plans.pipeline import Settings, published_contracts, published_tables, run_pipeline  # noqa: E402
from tallyhouse.plans.runs import run_metrics, tracked_run  # noqa: E402
from tallyhouse.plans.samples import EVENTS_AS_OF, ORDERS_AS_OF, WINDOW_DAYS, Samples  # noqa: E402
from tallyhouse.schemas import conform  # noqa: E402
from tallyhouse.session import new_folder  # noqa: E402
from tallyhouse.sources import csv, lineage  # noqa: E402
from tallyhouse.sources.warehouse import Warehouse  # noqa: E402

import oracle  # noqa: E402

try:
    import corpus_pipeline
    from tallyhouse.llm import queries as text_queries
except ImportError as missing:  # the text part is optional, and so are the libraries it needs; the rest goes on without it
    if getattr(missing, "name", None) not in ("corpus_pipeline", "tallyhouse.llm", "tallyhouse.llm.queries"):
        warnings.warn(f"text queries are left out: {missing}", stacklevel=1)
    text_queries = None

ORDER, PAYMENT = model.ORDER_COLUMNS, model.PAYMENT_COLUMNS
DAYS = WINDOW_DAYS
RUN_AT = datetime(2001, 8, 1, 6, 0)


def _round_trip(table: DataFrame, file: str, schema) -> DataFrame:
    """Write a table as CSV, then load it as the first load does."""
    folder = new_folder(table.sparkSession)
    csv.write_csv(table, f"{folder}/{file}")
    return csv.read_csv(table.sparkSession, f"{folder}/{file}", schema)


def _ingest_csv(s: Samples) -> DataFrame:
    return lineage.tag(_round_trip(s.raw_orders.select(*ORDER), "orders.csv", schemas.ORDERS_CSV), "orders.csv", lineage.BOOTSTRAP)


def _seed_if_empty(s: Samples) -> DataFrame:
    """An empty table takes the batch, and the table it became takes nothing of the next one."""
    batch = s.raw_orders.select(*ORDER)
    seeded = loads.seed_if_empty(s.spark.createDataFrame([], batch.schema), batch)
    return loads.seed_if_empty(seeded, s.orders_load.select(*ORDER))


def _load_daily(s: Samples) -> DataFrame:
    """Both raw tables after a first load and the same daily load twice, all from CSV files."""
    folder = new_folder(s.spark)
    warehouse = Warehouse(s.spark, f"{folder}/warehouse")
    csv.write_csv(s.raw_customers, f"{folder}/customers.csv")
    csv.write_csv(s.raw_products, f"{folder}/products.csv")
    csv.write_csv(s.orders_base.select(*ORDER), f"{folder}/orders.csv")
    csv.write_csv(s.payments_base.select(*PAYMENT), f"{folder}/payments.csv")
    csv.write_csv(s.orders_load.select(*ORDER), f"{folder}/orders_daily.csv")
    csv.write_csv(s.payments_load.select(*PAYMENT), f"{folder}/payments_daily.csv")
    loads.bootstrap(warehouse, folder, RUN_AT)
    for _ in range(2):
        loads.load_daily(warehouse, f"{folder}/orders_daily.csv", f"{folder}/payments_daily.csv", RUN_AT)
    tagged = [F.col(c) for c in ("source_file", "batch_id")] + [F.col("run_id").isNotNull().alias("has_run")]
    orders = warehouse.read("raw.orders", schemas.RAW_ORDERS)
    payments = warehouse.read("raw.payments", schemas.RAW_PAYMENTS)
    return orders.select(
        F.col("order_id").alias("id"), F.col("customer_id").alias("of"), F.col("order_total").alias("amount"), *tagged
    ).unionByName(
        payments.select(F.col("payment_id").alias("id"), F.col("order_id").alias("of"), F.col("payment_amount").alias("amount"), *tagged)
    )


def _lineage_tag(s: Samples) -> DataFrame:
    """Rows that already have a source keep it."""
    refund = F.col("order_total") < 0
    known = s.raw_orders.select(
        *ORDER,
        F.when(refund, F.lit("refunds.csv")).alias("source_file"),
        F.when(refund, F.lit("MANUAL")).alias("batch_id"),
    )
    return lineage.tag(known, "orders.csv", lineage.BOOTSTRAP)


def _warehouse(s: Samples) -> Warehouse:
    """A new warehouse with the raw tables."""
    warehouse = Warehouse(s.spark, new_folder(s.spark))
    with warehouse.load() as load:
        for table, df, schema in (
            ("raw.orders", s.raw_orders, schemas.RAW_ORDERS),
            ("raw.payments", s.raw_payments, schemas.RAW_PAYMENTS),
            ("raw.customers", s.raw_customers, schemas.RAW_CUSTOMERS),
            ("raw.products", s.raw_products, schemas.RAW_PRODUCTS),
        ):
            load.append(conform(df, schema), table)
    return warehouse


def _pipeline_fact(s: Samples) -> DataFrame:
    """The fact a whole pipeline run publishes from raw tables written to a new warehouse."""
    warehouse = _warehouse(s)
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    return warehouse.fact()


def _with_old_fact(s: Samples) -> Warehouse:
    """A warehouse whose fact is what an earlier run could have left: stale rows, other days, days that will be empty, rows without a day."""
    warehouse = _warehouse(s)
    with tracked_run(warehouse, DAYS, datetime(2001, 7, 31, 6, 0)) as run:
        filled = warehouse.write_fact_days(conform(s.fact_undated, schemas.FACT_ORDERS), run.run_id)
        warehouse.write_days_list(filled, run.run_id)
    return warehouse


def _pipeline_fact_rerun(s: Samples) -> DataFrame:
    """The fact after a run over an older one."""
    warehouse = _with_old_fact(s)
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    return warehouse.fact()


def _overlapping_runs(s: Samples) -> DataFrame:
    """The fact after two runs over an older one, at once: the second to be committed builds on the first."""
    warehouse = _with_old_fact(s)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda hour: run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT.replace(hour=hour)), (7, 8)))
    return warehouse.fact()


def _overlapping_loads(s: Samples) -> DataFrame:
    """Raw orders after a daily batch was loaded by two loads at once."""
    warehouse = Warehouse(s.spark, new_folder(s.spark))
    warehouse.append(conform(s.orders_base.select(*ORDER, "ingested_at"), schemas.RAW_ORDERS), "raw.orders")
    batch = s.orders_load.select(*ORDER)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: loads.load_batch(warehouse, "raw.orders", batch, "orders_daily.csv", RUN_AT), range(2)))
    return warehouse.read("raw.orders", schemas.RAW_ORDERS).select(*ORDER)


def _runs_by_deltas(s: Samples) -> DataFrame:
    """Quarantine and clean tables after two loads with a run each: the second load has new keys, further copies of old
    orders, payments of old orders, and orders of old payments."""
    warehouse = Warehouse(s.spark, new_folder(s.spark))
    for rest in (False, True):
        with warehouse.load() as load:
            for table, df, schema, of in (
                ("raw.orders", s.raw_orders, schemas.RAW_ORDERS, "CASE WHEN ingested_at = order_date THEN 7 ELSE 1 END"),
                ("raw.payments", s.raw_payments, schemas.RAW_PAYMENTS, "5"),
            ):
                key = df.columns[0]
                late = F.expr(f"try_cast(substr({key}, 2) AS BIGINT) % {of} = 0")
                load.append(conform(df.where(late if rest else ~late), schema), table)
        run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    parts = []
    for table, schema, amount in (
        ("raw.quarantine_orders", schemas.QUARANTINE_ORDERS, "order_total"),
        ("raw.quarantine_payments", schemas.QUARANTINE_PAYMENTS, "payment_amount"),
        ("staging.orders_clean", schemas.RAW_ORDERS, "order_total"),
        ("staging.payments_clean", schemas.RAW_PAYMENTS, "payment_amount"),
    ):
        rows = warehouse.newest(table, schema)
        reason = F.col("reason") if "reason" in rows.columns else F.lit(None).cast("string")
        parts.append(rows.select(F.lit(table).alias("name"), F.col(rows.columns[0]).alias("id"), F.col(amount).alias("amount"), reason.alias("reason")))
    return reduce(DataFrame.unionByName, parts)


def _published_totals(s: Samples) -> DataFrame:
    """Daily totals of a published fact, as its list of days has them."""
    warehouse = Warehouse(s.spark, new_folder(s.spark))
    with tracked_run(warehouse, DAYS, RUN_AT) as run:
        days = warehouse.write_fact_days(conform(s.fact_events, schemas.FACT_ORDERS), run.run_id)
        warehouse.write_days_list(days, run.run_id)
    return warehouse.fact_totals()


def _run_counts(s: Samples) -> DataFrame:
    """The metrics a run logs, from counts taken while its tables were written."""
    warehouse = _warehouse(s)
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    return warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS).drop("run_timestamp")


def _failed_run(s: Samples) -> Warehouse:
    """A good run, then one that the quality gate stops."""
    warehouse = _warehouse(s)
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    try:
        run_pipeline(warehouse, ORDERS_AS_OF, Settings(max_errors=0), now=RUN_AT)
    except quality.QualityGateBreached:
        pass
    return warehouse


def _run_states(s: Samples) -> DataFrame:
    return _failed_run(s).runs().select("status", "started_at", F.col("finished_at").isNotNull().alias("ended"), "window_days", "notes")


def _run_outputs(s: Samples) -> DataFrame:
    """What is there of rebuilt tables and logs after a good and a failed run, with the moment of the run."""
    warehouse = _failed_run(s)
    bad = warehouse.newest("raw.quarantine_orders", schemas.QUARANTINE_ORDERS)
    log = warehouse.log("analytics.pipeline_metrics", schemas.PIPELINE_METRICS)
    clean = warehouse.newest("staging.payments_clean", schemas.RAW_PAYMENTS)
    return (
        bad.groupBy(F.lit("quarantine_orders").alias("name"), F.col("quarantined_at").alias("at")).agg(F.count("*").alias("n"))
        .unionByName(log.groupBy(F.lit("pipeline_metrics").alias("name"), F.col("run_timestamp").alias("at")).agg(F.count("*").alias("n")))
        .unionByName(clean.groupBy(F.lit("payments_clean").alias("name"), F.lit(RUN_AT).cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("n")))
    )


def _contracts(s: Samples) -> DataFrame:
    """All contracts on a warehouse after a run over an older fact."""
    warehouse = _with_old_fact(s)
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    return reduce(DataFrame.unionByName, published_contracts(warehouse))


CONTRACTS = """
-- A check that passes, one that fails, and one without a row.
SELECT 'orders_are_days' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failing_rows
FROM {fact_orders} WHERE order_day IS NULL AND order_id IS NULL;
SELECT 'no_quarantine' AS check_name, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS failing_rows
FROM {quarantine_orders} q JOIN {raw_orders} r ON q.order_id = r.order_id AND q.order_total = r.order_total;
SELECT 'nothing' AS check_name, 'FAIL' AS status, 1 AS failing_rows FROM {pipeline_runs} WHERE status = 'failed';
"""


def _contracts_from_file(s: Samples) -> DataFrame:
    """A user's file of contracts on a warehouse after a run."""
    warehouse, path = _warehouse(s), new_folder(s.spark, "contracts")
    run_pipeline(warehouse, ORDERS_AS_OF, now=RUN_AT)
    s.spark.createDataFrame([(CONTRACTS,)], "value string").coalesce(1).write.text(path)
    return reduce(DataFrame.unionByName, contracts.file_contracts(s.spark, path, published_tables(warehouse)))


def _placed(df: DataFrame) -> DataFrame:
    """A sorted result with the place of each row, as it comes out."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id())


def _yearly_metrics(s: Samples) -> DataFrame:
    """One metrics row per year of ingest, as if every year had been one run."""
    tables = {
        "raw_orders_count": s.raw_orders,
        "quarantined_orders": quality.quarantine(s.raw_orders, model.order_rules(s.raw_orders, s.repeated)),
        "clean_orders_count": s.orders_clean,
        "raw_payments_count": s.raw_payments,
        "quarantined_payments": quality.quarantine(
            s.raw_payments, [*model.payment_row_rules(), model.paid_mismatch(s.raw_orders)]
        ),
        "clean_payments_count": s.payments_clean,
    }
    tagged = None
    for name, df in tables.items():
        part = df.select(F.year("ingested_at").alias("y"), F.lit(name).alias("counted"))
        tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("y").agg(
        *[F.count(F.when(F.col("counted") == name, F.lit(1))).alias(name) for name in tables]
    )
    at = F.make_timestamp_ntz(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return counts.select(at.alias("run_timestamp"), F.lit(DAYS).alias("window_days"), *tables)


def _pipeline_metrics(s: Samples) -> DataFrame:
    row = run_metrics(
        DAYS,
        RUN_AT,
        s.raw_orders,
        s.quarantine_orders,
        s.orders_clean,
        s.raw_payments,
        s.quarantine_payments,
        s.payments_clean,
    )
    return row.drop("run_timestamp")


def _trailing_stats(s: Samples) -> DataFrame:
    scored = trends.scored_days(s.fact_events)
    places = {"revenue": 2, "avg_prior": 2, "std_prior": 2, "pct_change": 4, "z": 4}
    return scored.select(
        "order_day", "orders", *[F.round(F.col(c).cast("double"), n).alias(c) for c, n in places.items()]
    )


def _anomaly_log(s: Samples) -> DataFrame:
    return reports.anomaly_log(s.fact_events, EVENTS_AS_OF, DAYS, "RUN", RUN_AT)


def _upserted(s: Samples) -> DataFrame:
    return merge.rebuild_window(s.fact_prev, s.fact_incoming, ["order_id"], "order_day", ORDERS_AS_OF, DAYS)


def _gate(s: Samples) -> DataFrame:
    counted = {"quarantined_orders": s.quarantine_orders, "quarantined_payments": s.quarantine_payments}
    return quality.gate_report(counted, max_errors=500)


REGISTERED: dict[str, Callable[[Samples], DataFrame]] = {
    # Loads and lineage.
    "ingest_csv": _ingest_csv,
    "seed_if_empty": _seed_if_empty,
    "lineage_tag": _lineage_tag,
    "ingest_csv_customers": lambda s: _round_trip(s.raw_customers, "customers.csv", schemas.CUSTOMERS_CSV),
    "load_daily": _load_daily,
    "insert_ignore_orders": lambda s: merge.insert_ignore(
        s.orders_base, s.orders_load, ["order_id"], ["ingested_at"]
    ).select(*ORDER),
    "insert_ignore_payments": lambda s: merge.insert_ignore(
        s.payments_base, s.payments_load, ["payment_id"], ["ingested_at"]
    ).select(*PAYMENT),
    # Quality.
    "q_duplicate_orders": lambda s: keys.duplicates(s.raw_orders, ["order_id"], ["ingested_at"], s.repeated).select(*ORDER),
    "q_missing_customer": lambda s: quality.missing("customer_id").violations(s.raw_orders).select(*ORDER),
    "q_negative_total": lambda s: quality.below("order_total", 0, "negative order_total")
    .violations(s.raw_orders)
    .select(*ORDER),
    "q_missing_payment_order": lambda s: quality.missing("order_id").violations(s.raw_payments).select(*PAYMENT),
    "q_paid_mismatch": lambda s: model.paid_mismatch(s.raw_orders).violations(s.raw_payments).select(*PAYMENT),
    "quarantine_orders": lambda s: s.quarantine_orders,
    "quarantine_payments": lambda s: s.quarantine_payments,
    "orders_clean": lambda s: s.orders_clean.select(*ORDER),
    "orders_clean_keep_first": lambda s: model.clean_orders(s.raw_orders, "keep_first", s.repeated).select(*ORDER),
    "payments_clean": lambda s: s.payments_clean.select(*PAYMENT),
    "dedupe_keep_first": lambda s: keys.first_per_key(s.raw_orders, ["order_id"], ["ingested_at"]).select(*ORDER),
    "key_violations": lambda s: keys.key_violations(s.raw_orders, ["order_id"]),
    "quality_gate": _gate,
    # Fact and dimensions.
    "fact_orders_full": lambda s: s.fact_full,
    "fact_orders_window": lambda s: model.fact_orders(*s.staging, ORDERS_AS_OF, DAYS),
    "fact_orders_upsert": _upserted,
    "pipeline_fact": _pipeline_fact,
    "pipeline_fact_rerun": _pipeline_fact_rerun,
    "pipeline_overlapping_runs": _overlapping_runs,
    "overlapping_loads": _overlapping_loads,
    "pipeline_deltas": _runs_by_deltas,
    "pipeline_counts": _run_counts,
    "dim_customer": lambda s: model.dim_customer(s.raw_customers),
    "dim_product": lambda s: model.dim_product(s.raw_products),
    "dim_date": lambda s: model.dim_date(s.orders_clean),
    # Trends.
    "daily_paid_revenue": lambda s: trends.daily_paid_revenue(s.fact_events),
    "trailing_stats": _trailing_stats,
    "revenue_anomaly_daily": lambda s: reports.revenue_anomaly_daily(s.fact_events),
    "revenue_trend": lambda s: reports.revenue_trend(s.fact_events),
    "revenue_anomalies": lambda s: reports.revenue_anomalies(s.fact_events),
    "anomaly_log": lambda s: _anomaly_log(s).drop("run_id", "detected_at"),
    # Reports.
    "kpi_summary": lambda s: reports.kpi_summary(s.fact_events),
    "daily_revenue": lambda s: reports.daily_revenue(s.fact_events),
    "orders_per_day": lambda s: reports.orders_per_day(s.fact_events),
    "payment_status_dist": lambda s: reports.payment_status_dist(s.fact_events),
    "top_cities": lambda s: reports.top_cities(s.fact_full, model.dim_customer(s.raw_customers)),
    "published_kpi": lambda s: reports.kpi_of_totals(_published_totals(s)),
    "published_daily_revenue": lambda s: reports.daily_revenue_of_totals(_published_totals(s)),
    "published_orders_per_day": lambda s: reports.orders_per_day_of_totals(_published_totals(s)),
    "published_payment_status": lambda s: reports.payment_status_of_totals(_published_totals(s)),
    "published_anomaly_daily": lambda s: reports.revenue_anomaly_of_totals(_published_totals(s)),
    "daily_revenue_in_order": lambda s: _placed(reports.daily_revenue(s.fact_events)),
    "orders_per_day_in_order": lambda s: _placed(reports.orders_per_day(s.fact_events)),
    "payment_status_in_order": lambda s: _placed(reports.payment_status_dist(s.fact_events)),
    "revenue_anomalies_in_order": lambda s: _placed(reports.revenue_anomalies(s.fact_events)),
    # Runs, run metrics and contracts.
    "run_states": _run_states,
    "run_outputs": _run_outputs,
    "contracts": _contracts,
    "contracts_from_file": _contracts_from_file,
    "pipeline_metrics": _pipeline_metrics,
    "metrics_trend": lambda s: reports.metrics_trend(_yearly_metrics(s)),
    "latest_metrics": lambda s: contracts.latest_metrics(_yearly_metrics(s)),
    "contract_duplicate_key": lambda s: contracts.no_duplicate_key(
        _upserted(s), "order_id", "fact_orders_duplicate_order_id"
    ),
    "contract_null_key": lambda s: contracts.no_null_key(_upserted(s), "order_id", "fact_orders_null_order_id"),
    "contract_quarantine_rate": lambda s: contracts.quarantine_rate_at_most(
        _yearly_metrics(s), 0.05, "payments_quarantine_rate"
    ),
    "contract_anomaly_count": lambda s: contracts.anomalies_at_most(_anomaly_log(s), 5, "recent_anomalies_count"),
}


def _comparable(df: DataFrame) -> DataFrame:
    """Money as double, the form both engines hand over alike."""
    decimal = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.select(*[F.col(c).cast("double").alias(c) if c in decimal else F.col(c) for c in df.columns])


def _registered(rule: Callable[[Samples], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _comparable(rule(Samples(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _registered(rule) for name, rule in REGISTERED.items()}
    if text_queries:
        found |= text_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.oracle_sql()
    if text_queries:
        found |= text_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Daily revenue with trailing statistics and the anomaly flag."""
    return queries()["revenue_anomaly_daily"](spark, "/root/testdata/sf0.001")
