"""Quarantine and clean tables kept up by deltas.

All rules but one look at the rows of one key, and the payment rule at the orders of one key. So a new load can only change
the verdict on its own rows and on older rows with their keys. Loads know the range of their keys, so older rows are looked for
only in loads whose range the new keys reach into, by a semi join with those keys. The rows of all touched keys are
judged together, from nothing, and become a layer; what older layers hold of these keys no longer counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.functions import day_of
from tallyhouse.operators.keys import repeated_keys
from tallyhouse.plans import model
from tallyhouse.plans.runs import Run
from tallyhouse.schemas import conform
from tallyhouse.sources.manifests import Layer, LoadEntry, Manifest, Part, Range, RunEntry, place
from tallyhouse.sources.warehouse import LAYERED, TOUCHED, Warehouse

ORDERS, PAYMENTS = "raw.orders", "raw.payments"
#: Rows of a quarantine table as layers hold them; the moment is that of the run they are read for.
STORED = {
    "raw.quarantine_orders": schemas.QUARANTINE_ORDERS,
    "raw.quarantine_payments": schemas.QUARANTINE_PAYMENTS,
    "staging.orders_clean": schemas.RAW_ORDERS,
    "staging.payments_clean": schemas.RAW_PAYMENTS,
}
COUNTS = {
    "raw.quarantine_orders": "quarantined_orders",
    "raw.quarantine_payments": "quarantined_payments",
    "staging.orders_clean": "clean_orders_count",
    "staging.payments_clean": "clean_payments_count",
}


@dataclass(frozen=True)
class Refined:
    """The tables as a run will publish them."""

    orders: DataFrame
    payments: DataFrame
    order_days: DataFrame
    layers: tuple[Layer, ...]
    counts: dict[str, int]


def widest(ranges: Sequence[Range]) -> Range:
    """The range over some ranges."""
    found = [r for r in ranges if r]
    return (min((r[0] for r in found), key=place), max((r[1] for r in found), key=place)) if found else None


def range_of(parts: Sequence[Part], column: str) -> tuple[Range, bool]:
    """The range of a column over some parts, and whether it has NULLs."""
    return widest([p.ranges.get(column) for p in parts]), any(p.nulls.get(column, 0) for p in parts)


def with_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose key, NULL included, is among ``keys``."""
    wanted = keys.select(F.col(column).alias("_wanted"))
    return df.join(wanted, F.col(column).eqNullSafe(F.col("_wanted")), "left_semi")


def previous(run: Run, mode: str, max_layers: int) -> RunEntry | None:
    """The run to build on, None if all has to be made anew."""
    last = run.base.newest_run()
    if last is None or not last.layers or last.mode != mode or len(last.layers) >= max_layers:
        return None
    return last


def refine(warehouse: Warehouse, run: Run, on_duplicate: str = "drop_all", max_layers: int = 16) -> Refined:
    """Write a run's layer of the quarantine and clean tables, and return the clean tables with all counts."""
    spark, last = warehouse.spark, previous(run, on_duplicate, max_layers)
    older: tuple[LoadEntry, ...] = run.base.loads[: last.covers] if last else ()
    newer: tuple[LoadEntry, ...] = run.base.loads[last.covers if last else 0 :]

    if last and not newer:
        days = warehouse.write_run(warehouse.newest("work.order_days", schemas.ORDER_DAYS, last), "work.order_days", run.run_id)
        return Refined(*clean_tables(warehouse, last.layers), days, last.layers, last.counts)

    def keep(df: DataFrame, table: str, ids: Sequence[str] = ()) -> tuple[DataFrame, Part]:
        return warehouse.write_counted(df, table, run.run_id, ids)

    def old_rows(table: str, schema: T.StructType, column: str, wanted: tuple[Range, bool], keys: DataFrame) -> DataFrame | None:
        """Rows of older loads with one of the keys; loads that cannot hold one are not opened, and None is for no such load."""
        if not any(part.may_hold(column, *wanted) for part in Manifest().parts(table, older)):
            return None
        return with_keys(warehouse.read_holding(table, schema, older, column, *wanted), keys, column)

    orders = warehouse.read(ORDERS, schemas.RAW_ORDERS, newer)
    payments = warehouse.read(PAYMENTS, schemas.RAW_PAYMENTS, newer)
    order_range = range_of(Manifest().parts(ORDERS, newer), "order_id")
    id_range = range_of(Manifest().parts(PAYMENTS, newer), "payment_id")
    paid_range = range_of(Manifest().parts(PAYMENTS, newer), "order_id")[0]
    touched = {key: 0 for key in TOUCHED}
    keys: dict[str, DataFrame] = {}

    # Orders: the new ones, and older ones with their keys.
    order_ids = orders.select("order_id").distinct()
    old_orders = old_rows(ORDERS, schemas.RAW_ORDERS, "order_id", order_range, order_ids)
    if old_orders is not None:
        old_orders, _ = keep(old_orders, "work.old_orders")
        orders = orders.unionByName(old_orders)
        keys["order_id"], part = keep(old_orders.select("order_id").distinct(), TOUCHED["order_id"])
        touched["order_id"] = part.rows

    # Payments: the new ones, older ones of those orders, and all rows with an id of either.
    payment_ids = payments.select("payment_id").distinct()
    of_orders = old_rows(PAYMENTS, schemas.RAW_PAYMENTS, "order_id", (order_range[0], False), order_ids)
    if of_orders is not None:
        both = payments.select("payment_id").unionByName(of_orders.select("payment_id")).distinct()
        payment_ids, part = keep(both, "work.payment_ids", ["payment_id"])
        id_range = range_of([part], "payment_id")
    old_payments = old_rows(PAYMENTS, schemas.RAW_PAYMENTS, "payment_id", id_range, payment_ids)
    if old_payments is not None:
        old_payments, part = keep(old_payments, "work.old_payments", ["order_id"])
        payments, paid_range = payments.unionByName(old_payments), widest([paid_range, part.ranges["order_id"]])
        keys["payment_id"], part = keep(old_payments.select("payment_id").distinct(), TOUCHED["payment_id"])
        touched["payment_id"] = part.rows

    # The layer. Payments meet the orders of all loads that can have theirs.
    repeated, _ = keep(repeated_keys(orders, ["order_id"]), "work.repeated_orders")
    against = warehouse.read_holding(ORDERS, schemas.RAW_ORDERS, run.base.loads, "order_id", paid_range)
    bad_payments, bad = keep(model.quarantined_payments(payments, against), "raw.quarantine_payments")
    made = {
        "raw.quarantine_orders": keep(model.quarantined_orders(orders, repeated), "raw.quarantine_orders")[1],
        "raw.quarantine_payments": bad,
        "staging.orders_clean": keep(model.clean_orders(orders, on_duplicate, repeated), "staging.orders_clean")[1],
        "staging.payments_clean": keep(model.clean_payments(payments, bad_payments), "staging.payments_clean")[1],
    }
    layers = (*(last.layers if last else ()), Layer(run.run_id, touched))

    def superseded(table: str) -> DataFrame:
        """What older layers hold of touched keys."""
        return with_keys(warehouse.layered(table, last.layers, stored_schema(table)), keys[LAYERED[table]], LAYERED[table])

    # Counts: those of the last run, less what it has of touched keys, plus the layer's.
    counts = {
        "raw_orders_count": sum(p.rows for p in Manifest().parts(ORDERS, run.base.loads)),
        "raw_payments_count": sum(p.rows for p in Manifest().parts(PAYMENTS, run.base.loads)),
    }
    for table, name in COUNTS.items():
        gone = superseded(table).count() if last and touched[LAYERED[table]] else 0
        counts[name] = (last.counts[name] if last else 0) - gone + made[table].rows

    # Clean orders per day, kept up in the same way.
    layer = spark.read.schema(schemas.RAW_ORDERS).parquet(warehouse.path("staging.orders_clean", run.run_id))
    changes = [per_day(layer, 1)]
    if last:
        changes.append(warehouse.newest("work.order_days", schemas.ORDER_DAYS, last))
        if touched["order_id"]:
            changes.append(per_day(superseded("staging.orders_clean"), -1))
    summed = reduce(DataFrame.unionByName, changes).groupBy("order_date").agg(F.sum("orders").alias("orders"))
    order_days = warehouse.write_run(conform(summed.where("orders > 0"), schemas.ORDER_DAYS), "work.order_days", run.run_id)

    return Refined(*clean_tables(warehouse, layers), order_days, layers, counts)


def clean_tables(warehouse: Warehouse, layers: Sequence[Layer]) -> list[DataFrame]:
    return [warehouse.layered(t, layers, stored_schema(t)) for t in ("staging.orders_clean", "staging.payments_clean")]


def stored_schema(table: str) -> T.StructType:
    return T.StructType([f for f in STORED[table].fields if f.name != "quarantined_at"])


def per_day(orders: DataFrame, sign: int) -> DataFrame:
    return orders.groupBy(day_of("order_date").alias("order_date")).agg((sign * F.count("*")).alias("orders"))
