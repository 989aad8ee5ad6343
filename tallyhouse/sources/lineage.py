"""Where a raw row came from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import moment

BOOTSTRAP = "BOOTSTRAP"
DAILY = "BATCH_DAILY"


def tag(df: DataFrame, source_file: str, batch_id: str) -> DataFrame:
    """Fill ``source_file`` and ``batch_id`` of rows that have no source file yet."""
    for column in ("source_file", "batch_id"):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    untagged = F.col("source_file").isNull()
    # batch_id first: its condition looks at the source file as it was.
    return df.withColumn("batch_id", F.when(untagged, F.lit(batch_id)).otherwise(F.col("batch_id"))).withColumn(
        "source_file", F.coalesce(F.col("source_file"), F.lit(source_file))
    )


def stamp(df: DataFrame, ingested_at: datetime, run_id: str | None = None) -> DataFrame:
    """One ingest moment for the whole batch, and the run that brought it."""
    df = df.withColumn("ingested_at", moment(ingested_at))
    return df if run_id is None else df.withColumn("run_id", F.lit(run_id))
