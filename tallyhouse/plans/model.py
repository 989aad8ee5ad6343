"""The order model: its quality rules, clean tables, fact and dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import blank_to_null, day_of, day_of_week
from tallyhouse.operators.merge import in_window
from tallyhouse.operators.quality import (
    DuplicateRule,
    MismatchRule,
    RowRule,
    Rule,
    below,
    clean_split,
    exclude,
    missing,
    quarantine,
)

ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "order_total"]
PAYMENT_COLUMNS = ["payment_id", "order_id", "payment_status", "payment_amount"]


def earliest(raw: DataFrame) -> list[str]:
    """What decides which copy of a row came first; equal rows are told apart by their other columns."""
    return [column for column in ("ingested_at", "source_file") if column in raw.columns]


def order_row_rules() -> list[RowRule]:
    return [missing("customer_id"), below("order_total", 0, "negative order_total")]


def payment_row_rules() -> list[RowRule]:
    return [missing("order_id")]


def order_rules(raw_orders: DataFrame, repeated: DataFrame | None = None) -> list[Rule]:
    duplicate = DuplicateRule("duplicate order_id", ["order_id"], earliest(raw_orders), repeated)
    return [duplicate, *order_row_rules()]


def paid_mismatch(raw_orders: DataFrame) -> MismatchRule:
    return MismatchRule(
        "paid amount != order_total",
        other=raw_orders,
        key="order_id",
        value="payment_amount",
        other_value="order_total",
        when=F.col("payment_status") == "paid",
    )


def quarantined_orders(
    raw_orders: DataFrame, repeated: DataFrame | None = None, at: datetime | None = None
) -> DataFrame:
    needed = raw_orders.select(*ORDER_COLUMNS, *earliest(raw_orders))
    found = quarantine(needed, order_rules(needed, repeated), at)
    return found.select(*ORDER_COLUMNS, "reason", *(["quarantined_at"] if at else []))


def quarantined_payments(raw_payments: DataFrame, raw_orders: DataFrame, at: datetime | None = None) -> DataFrame:
    needed = raw_payments.select(*PAYMENT_COLUMNS)
    found = quarantine(needed, [*payment_row_rules(), paid_mismatch(raw_orders)], at)
    return found.select(*PAYMENT_COLUMNS, "reason", *(["quarantined_at"] if at else []))


def clean_orders(
    raw_orders: DataFrame, on_duplicate: str = "drop_all", repeated: DataFrame | None = None
) -> DataFrame:
    return clean_split(raw_orders, order_row_rules(), "order_id", earliest(raw_orders), on_duplicate, repeated)


def clean_payments(raw_payments: DataFrame, quarantined: DataFrame) -> DataFrame:
    return exclude(raw_payments, quarantined, "payment_id")


def placed_orders(orders: DataFrame, as_of: date | None = None, days: int | None = None) -> DataFrame:
    """The order side of the fact; with ``as_of`` only the window's days."""
    placed = orders.select("order_id", "customer_id", day_of("order_date").alias("order_day"), "order_total")
    return placed if as_of is None else in_window(placed, "order_day", as_of, days)


def with_payments(placed: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their payment, if any."""
    return placed.join(payments.select("order_id", "payment_status", "payment_amount"), "order_id", "left")


def payments_of(placed: DataFrame, payments: DataFrame) -> DataFrame:
    """Payments that can belong to ``placed`` orders.

    With a written ``placed`` Spark knows its size: order ids of a short window are sent to the payments, which
    are then not shuffled; those of a long one meet them in a shuffle that the join with the orders uses again.
    """
    return payments.join(placed.select("order_id").filter(F.col("order_id").isNotNull()), "order_id", "left_semi")


def fact_orders(
    orders: DataFrame, payments: DataFrame, as_of: date | None = None, days: int | None = None
) -> DataFrame:
    """Clean orders with their payment, if any; with ``as_of`` only the window's days."""
    return with_payments(placed_orders(orders, as_of, days), payments)


def dim_customer(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id", blank_to_null("name"), blank_to_null("email"), blank_to_null("city"), "created_at"
    )


def dim_product(raw_products: DataFrame) -> DataFrame:
    return raw_products.select("product_id", "product_name", "category", "price")


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day with an order. Days are made distinct before the parts are taken."""
    day = F.col("date_day")
    return (
        orders.select(day_of("order_date").alias("date_day"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            day_of_week(day).alias("day_of_week"),
        )
    )
