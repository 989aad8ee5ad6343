"""Loads of the raw layer: the first load of empty tables and daily increments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.operators.keys import assert_key
from tallyhouse.operators.merge import new_rows
from tallyhouse.schemas import conform, limit_ids
from tallyhouse.session import Keep, scratch
from tallyhouse.sources import lineage
from tallyhouse.sources.csv import CORRUPT, read_csv, read_csv_split
from tallyhouse.sources.csv_ranges import read_csv_ranges
from tallyhouse.sources.warehouse import Load, Warehouse, by_length

# table: (file, columns of the file, raw schema, key, has lineage columns)
RAW_TABLES: dict[str, tuple[str, T.StructType, T.StructType, str, bool]] = {
    "raw.customers": ("customers.csv", schemas.CUSTOMERS_CSV, schemas.RAW_CUSTOMERS, "customer_id", False),
    "raw.products": ("products.csv", schemas.PRODUCTS_CSV, schemas.RAW_PRODUCTS, "product_id", False),
    "raw.orders": ("orders.csv", schemas.ORDERS_CSV, schemas.RAW_ORDERS, "order_id", True),
    "raw.payments": ("payments.csv", schemas.PAYMENTS_CSV, schemas.RAW_PAYMENTS, "payment_id", True),
}


def seed_if_empty(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` when ``target`` has no row yet, else ``target`` as it is. Looks at one row."""
    return batch if target.isEmpty() else target


def read_batch(
    load: Load, table: str, path: str, now: datetime, multiline: bool, set_aside: bool, keep: Keep
) -> tuple[DataFrame, DataFrame | None]:
    """A CSV file as rows of a raw table, and with ``set_aside`` the lines that do not parse, which else fail the load."""
    spark, csv_schema = load.warehouse.spark, RAW_TABLES[table][1]
    if not set_aside:
        rows = read_csv_ranges(spark, path, csv_schema, keep) if multiline else read_csv(spark, path, csv_schema)
        return lineage.stamp(limit_ids(rows), now, load.run_id), None
    rows, bad = read_csv_split(spark, path, csv_schema, multiline)
    bad = lineage.stamp(bad.withColumnRenamed(CORRUPT, "line"), now, load.run_id)
    return lineage.stamp(limit_ids(rows), now, load.run_id), bad.withColumn("source_file", F.lit(file_name(path)))


def file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def bootstrap(
    warehouse: Warehouse,
    folder: str,
    now: datetime | None = None,
    run_id: str | None = None,
    multiline: bool = True,
    set_aside: bool = False,
) -> list[str]:
    """Load the base CSV files into raw tables that are still empty, all or none; return the tables loaded.

    All tables but orders must satisfy their key; repeated orders are for the quality rules to find. ``multiline`` allows line
    breaks in quoted cells, as a bulk COPY does, for one more pass that counts quotes. ``set_aside`` sends lines that do not parse to
    ``raw.<table>_rejected`` in place of failing; with ``multiline`` one task then reads a file.
    """
    now = now or datetime.now()
    loaded = []
    with warehouse.load(run_id) as load, scratch(warehouse.spark) as keep:
        for table, (file, _, raw_schema, key, with_lineage) in RAW_TABLES.items():
            if not load.read(table, raw_schema).isEmpty():
                continue  # its file is not opened
            batch, bad = read_batch(load, table, f"{folder.rstrip('/')}/{file}", now, multiline, set_aside, keep)
            if bad is not None:
                load.append(bad, f"{table}_rejected")
            if with_lineage:
                batch = lineage.tag(batch, file, lineage.BOOTSTRAP)
            part = load.append(conform(batch, raw_schema), table, seed=True)
            if table != "raw.orders":
                # Looked at in what was written, so that the file is read once; a load that fails leaves nothing.
                assert_key(warehouse.read_parts(table, raw_schema, [part]), [key], table)
            loaded.append(table)
    return [table for table in loaded if table in load.parts]


def rows_to_add(load: Load, table: str, batch: DataFrame, source_file: str, keep: Keep) -> DataFrame:
    """Rows of a daily batch whose key a raw table does not have yet, with their lineage."""
    _, _, raw_schema, key, _ = RAW_TABLES[table]
    tagged = conform(lineage.tag(batch, source_file, lineage.DAILY), raw_schema)

    def may_know(first: DataFrame) -> DataFrame:
        """The loads whose keys reach into the range of the batch's; a batch of new, rising keys meets none."""
        low, high = first.agg(F.min(by_length(key)), F.max(by_length(key))).first()
        wanted = (low["value"], high["value"]) if low else None
        return load.warehouse.read_holding(table, raw_schema, load.base.loads, key, wanted)

    return new_rows(may_know, tagged, [key], ["ingested_at"], keep)


def load_batch(
    warehouse: Warehouse, table: str, batch: DataFrame, source_file: str, now: datetime, run_id: str | None = None
) -> None:
    """Insert a daily batch into a raw table; rows with a known key are ignored.

    Only the new rows are appended, so running the same batch again adds nothing, nor does running it twice at once: the
    load that is committed second leaves out what the first has brought.
    """
    with warehouse.load(run_id) as load, scratch(warehouse.spark) as keep:
        stamped = lineage.stamp(limit_ids(batch), now, load.run_id)
        load.append(rows_to_add(load, table, stamped, source_file, keep), table, RAW_TABLES[table][3])


def load_daily(
    warehouse: Warehouse,
    orders_csv: str,
    payments_csv: str,
    now: datetime | None = None,
    run_id: str | None = None,
    multiline: bool = True,
    set_aside: bool = False,
) -> None:
    """Insert one day's orders and payments: both tables grow together, or neither. See ``bootstrap`` for the options."""
    now = now or datetime.now()
    sources = {"raw.orders": orders_csv, "raw.payments": payments_csv}
    for path in sources.values():
        if not warehouse.exists(path):
            raise FileNotFoundError(path)
    with warehouse.load(run_id) as load, scratch(warehouse.spark) as keep:
        for table, path in sources.items():
            batch, bad = read_batch(load, table, path, now, multiline, set_aside, keep)
            if bad is not None:
                load.append(bad, f"{table}_rejected")
            load.append(rows_to_add(load, table, batch, file_name(path), keep), table, RAW_TABLES[table][3])
