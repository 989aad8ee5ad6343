"""Declared schemas of the warehouse tables. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, DATE, INT, LONG = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()
MOMENT = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)
ID_LENGTH = 50
WIDE_MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(8, 2)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Columns of the incoming CSV files, in file order.
CUSTOMERS_CSV = _schema(customer_id=STRING, name=STRING, email=STRING, city=STRING, created_at=MOMENT)
PRODUCTS_CSV = _schema(product_id=STRING, product_name=STRING, category=STRING, price=MONEY)
ORDERS_CSV = _schema(order_id=STRING, customer_id=STRING, order_date=MOMENT, order_total=MONEY)
PAYMENTS_CSV = _schema(payment_id=STRING, order_id=STRING, payment_status=STRING, payment_amount=MONEY)

_LINEAGE = _schema(ingested_at=MOMENT, source_file=STRING, batch_id=STRING, run_id=STRING)

# Raw layer.
RAW_CUSTOMERS = T.StructType(CUSTOMERS_CSV.fields + [T.StructField("ingested_at", MOMENT)])
RAW_PRODUCTS = T.StructType(PRODUCTS_CSV.fields + [T.StructField("ingested_at", MOMENT)])
RAW_ORDERS = T.StructType(ORDERS_CSV.fields + _LINEAGE.fields)
RAW_PAYMENTS = T.StructType(PAYMENTS_CSV.fields + _LINEAGE.fields)

_VERDICT = _schema(reason=STRING, quarantined_at=MOMENT)
QUARANTINE_ORDERS = T.StructType(ORDERS_CSV.fields + _VERDICT.fields)
QUARANTINE_PAYMENTS = T.StructType(PAYMENTS_CSV.fields + _VERDICT.fields)

# Analytics layer.
FACT_ORDERS = _schema(
    order_id=STRING, customer_id=STRING, order_day=DATE, order_total=MONEY, payment_status=STRING, payment_amount=MONEY
)
# Which run wrote each day of the fact, totals of the day, and the range of its keys.
FACT_DAYS = _schema(
    order_day=DATE,
    version=STRING,
    orders=LONG,
    revenue=T.DecimalType(20, 2),
    paid=T.DecimalType(20, 2),
    lowest=STRING,
    highest=STRING,
    statuses=T.MapType(STRING, LONG),
)
# How many clean orders each day has.
ORDER_DAYS = _schema(order_date=DATE, orders=LONG)
DIM_CUSTOMER = CUSTOMERS_CSV
DIM_PRODUCT = PRODUCTS_CSV
DIM_DATE = _schema(date_day=DATE, year=INT, month=INT, day=INT, day_of_week=INT)
ANOMALY_LOG = _schema(
    run_id=STRING,
    detected_at=MOMENT,
    order_day=DATE,
    revenue=WIDE_MONEY,
    orders=INT,
    rev_avg_14d=WIDE_MONEY,
    rev_std_14d=WIDE_MONEY,
    pct_change_pct=RATE,
    z_score=RATE,
)
PIPELINE_RUNS = _schema(
    run_id=STRING, started_at=MOMENT, finished_at=MOMENT, status=STRING, window_days=INT, notes=STRING
)
# Counts are bigint: an int would overflow on tables of more than two billion rows.
PIPELINE_METRICS = _schema(
    run_timestamp=MOMENT,
    window_days=INT,
    raw_orders_count=LONG,
    quarantined_orders=LONG,
    clean_orders_count=LONG,
    raw_payments_count=LONG,
    quarantined_payments=LONG,
    clean_payments_count=LONG,
)


def limit_ids(df: DataFrame) -> DataFrame:
    """``df`` itself, failing when it is run if an id is longer than the declared length."""
    ids = {f.name for f in df.schema.fields if f.name.endswith("_id") and f.dataType == STRING}

    def checked(name: str):
        refuse = F.raise_error(F.lit(f"{name} is longer than {ID_LENGTH} characters"))
        return F.when(F.length(name) > ID_LENGTH, refuse).otherwise(F.col(name)).alias(name)

    return df.select(*[checked(c) if c in ids else F.col(c) for c in df.columns])


# Columns a table may lack; they are then NULL.
LINEAGE = frozenset(f.name for f in _LINEAGE.fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give ``df`` exactly the columns of ``schema``; only a lineage column it lacks becomes NULL."""
    lacking = [f.name for f in schema.fields if f.name not in df.columns]
    if refused := [name for name in lacking if name not in LINEAGE]:
        raise ValueError(f"columns {', '.join(refused)} are missing")
    return df.select(
        *[
            (F.lit(None) if f.name in lacking else F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
