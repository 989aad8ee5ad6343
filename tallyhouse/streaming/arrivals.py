"""Daily CSV files picked up as they arrive, as a file stream over a landing folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse.plans.loads import RAW_TABLES, load_batch
from tallyhouse.sources.csv import COPY_OPTIONS
from tallyhouse.sources.warehouse import Warehouse


def load_arrivals(warehouse: Warehouse, table: str, landing: str, checkpoint: str) -> StreamingQuery:
    """Load every file not loaded before, then stop. Each row keeps the name of its file.

    A batch that is run again after a failure adds nothing twice, because rows
    with a known key are ignored.
    """
    arrivals = (
        warehouse.spark.readStream.schema(RAW_TABLES[table][1])
        .options(**COPY_OPTIONS)
        .option("mode", "FAILFAST")
        .csv(landing)
        .withColumn("source_file", F.col("_metadata.file_name"))
        .withColumn("batch_id", F.lit("BATCH_DAILY"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(warehouse, table, batch, landing.rstrip("/").rsplit("/", 1)[-1], datetime.now())

    return (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
