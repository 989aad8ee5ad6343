"""The driver's test tables seen as this warehouse's tables.

The tables are clean, so defects are planted by arithmetic on the order key, the
same way at every size. All queries read whole tables: the arithmetic only decides
which rows carry which defect, which orders were never paid, and which rows an
earlier load or run had already brought in.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.keys import repeated_keys
from tallyhouse.operators.merge import in_window
from tallyhouse.plans import model
from tallyhouse.session import staged

# Last day of the order tables, and of the events.
ORDERS_AS_OF = date(2001, 8, 1)
EVENTS_AS_OF = date(2024, 1, 30)
WINDOW_DAYS = 7


@dataclass(frozen=True)
class Samples:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_orders(self) -> DataFrame:
        orders = self.table("orders")
        base = orders.selectExpr(
            "'O' || o_orderkey AS order_id",
            """CASE WHEN o_orderkey % 97 = 1 THEN NULL WHEN o_orderkey % 89 = 1 THEN ''
                    ELSE 'C' || o_custkey END AS customer_id""",
            "o_orderdate AS order_date",
            "CAST(CASE WHEN o_orderkey % 83 = 1 THEN -10.0D ELSE o_totalprice END AS DECIMAL(10,2)) AS order_total",
            "o_orderdate AS ingested_at",
        )
        second_copies = orders.filter("o_orderkey % 101 = 1").selectExpr(
            "'O' || o_orderkey AS order_id",
            "'C' || o_custkey AS customer_id",
            "o_orderdate AS order_date",
            "CAST(o_totalprice AS DECIMAL(10,2)) AS order_total",
            "o_orderdate + INTERVAL 1 DAY AS ingested_at",
        )
        return base.unionByName(second_copies)

    @cached_property
    def raw_payments(self) -> DataFrame:
        return (
            self.table("orders")
            .filter("o_orderkey % 31 <> 5")
            .selectExpr(
                "'P' || o_orderkey AS payment_id",
                """CASE WHEN o_orderkey % 79 = 1 THEN NULL WHEN o_orderkey % 73 = 1 THEN ''
                        ELSE 'O' || o_orderkey END AS order_id""",
                """CASE o_orderkey % 20 WHEN 7 THEN 'failed' WHEN 8 THEN 'pending' WHEN 9 THEN 'refunded'
                        ELSE 'paid' END AS payment_status""",
                """CAST(CASE WHEN o_orderkey % 20 = 7 THEN 0 WHEN o_orderkey % 50 = 1 THEN o_totalprice + 1.5
                        ELSE o_totalprice END AS DECIMAL(10,2)) AS payment_amount""",
                "o_orderdate AS ingested_at",
            )
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        nations = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.table("customer")
            .join(nations, "c_nationkey")
            .selectExpr(
                "'C' || c_custkey AS customer_id",
                "CASE WHEN c_custkey % 40 = 1 THEN '   ' ELSE '  ' || c_name || ' ' END AS name",
                "lower(c_name) || '@example.net' AS email",
                "CASE WHEN c_custkey % 25 = 1 THEN '' ELSE n_name END AS city",
                "TIMESTAMP_NTZ '1995-01-01 00:00:00' AS created_at",
            )
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "'S' || p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
        )

    @cached_property
    def fact_events(self) -> DataFrame:
        """Events as orders: enough of them per day to score, and all five payment states."""
        return self.table("events").selectExpr(
            "event_id AS order_id",
            "user_id AS customer_id",
            "CAST(ts AS DATE) AS order_day",
            "CAST(value AS DECIMAL(10,2)) AS order_total",
            """CASE event_type WHEN 'purchase' THEN 'paid' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'pending'
                    WHEN 'click' THEN 'refunded' END AS payment_status""",
            "CAST(CASE event_type WHEN 'purchase' THEN value ELSE 0 END AS DECIMAL(10,2)) AS payment_amount",
        )

    @cached_property
    def repeated(self) -> DataFrame:
        return staged(repeated_keys(self.raw_orders, ["order_id"]), "repeated_orders")

    @cached_property
    def quarantine_orders(self) -> DataFrame:
        return model.quarantined_orders(self.raw_orders, self.repeated)

    @cached_property
    def quarantine_payments(self) -> DataFrame:
        return model.quarantined_payments(self.raw_payments, self.raw_orders)

    @cached_property
    def orders_clean(self) -> DataFrame:
        return model.clean_orders(self.raw_orders, repeated=self.repeated)

    @cached_property
    def payments_clean(self) -> DataFrame:
        bad = staged(self.quarantine_payments.select("payment_id"), "quarantined_payment_ids")
        return model.clean_payments(self.raw_payments, bad)

    @cached_property
    def staging(self) -> tuple[DataFrame, DataFrame]:
        """Clean orders and payments as written tables, the form the fact is built from."""
        return staged(self.orders_clean, "orders_clean"), staged(self.payments_clean, "payments_clean")

    @cached_property
    def fact_full(self) -> DataFrame:
        return model.fact_orders(*self.staging)

    @cached_property
    def fact_table(self) -> DataFrame:
        return staged(self.fact_full, "fact_orders")

    @cached_property
    def fact_incoming(self) -> DataFrame:
        return in_window(self.fact_table, "order_day", ORDERS_AS_OF, WINDOW_DAYS)

    @cached_property
    def fact_prev(self) -> DataFrame:
        """The fact as an earlier run could have left it: stale states, some orders on an older day."""
        key = F.expr("try_cast(substr(order_id, 2) AS BIGINT)")
        return self.fact_table.filter((F.col("order_day") <= F.lit(date(2001, 7, 30))) & (key % 11 != 0)).select(
            "order_id",
            "customer_id",
            F.when(
                (F.col("order_day") >= F.lit(date(2001, 7, 25))) & (key % 3 == 0), F.date_sub("order_day", 30)
            ).otherwise(F.col("order_day")).alias("order_day"),
            "order_total",
            F.lit("stale").alias("payment_status"),
            "payment_amount",
        )

    @cached_property
    def fact_undated(self) -> DataFrame:
        """``fact_prev`` with some rows that have lost their day, and its old days drawn together by month."""
        key = F.expr("try_cast(substr(order_id, 2) AS BIGINT)")
        day = F.when(F.col("order_day") < F.lit(date(2001, 6, 1)), F.trunc("order_day", "month")).otherwise(F.col("order_day"))
        return self.fact_prev.withColumn("order_day", F.when(key % 53 != 0, day))

    @cached_property
    def orders_base(self) -> DataFrame:
        """Orders already loaded; with ``orders_load`` this covers the whole table."""
        return self.raw_orders.filter("try_cast(substr(order_id, 2) AS BIGINT) % 10 <> 0")

    @cached_property
    def orders_load(self) -> DataFrame:
        """A batch of which half is loaded already, with other totals and with repeats."""
        return self.raw_orders.filter("try_cast(substr(order_id, 2) AS BIGINT) % 5 = 0").withColumn(
            "order_total", (F.col("order_total") + 1).cast("decimal(10,2)")
        )

    @cached_property
    def payments_base(self) -> DataFrame:
        return self.raw_payments.filter("try_cast(substr(payment_id, 2) AS BIGINT) % 10 <> 0")

    @cached_property
    def payments_load(self) -> DataFrame:
        return self.raw_payments.filter("try_cast(substr(payment_id, 2) AS BIGINT) % 5 = 0").withColumn(
            "payment_amount", (F.col("payment_amount") + 1).cast("decimal(10,2)")
        )
