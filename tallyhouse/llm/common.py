"""What the text operators share: reading a table, and running a function over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyhouse.session import new_folder

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the stage at hand, not what came before. The
    next plan knows the real size, so Spark broadcasts the result only when it is small.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str = "text"):
    """The bytes of a text, a null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


#: Rows a function sees together: a whole Arrow batch and its result side by side would double a worker's memory.
ROWS_AT_ONCE = 500


def by_batch(
    df: DataFrame, rows: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]], schema: str
) -> DataFrame:
    """Run a function over the Arrow batches of every partition, a few hundred rows at a time.

    ``rows()`` is called once per task, for state kept over its batches, and returns the function
    from a batch to the columns of its result.
    """
    types = to_arrow(schema)

    def column(values, kind: pa.DataType) -> pa.Array:
        if isinstance(values, (pa.Array, pa.ChunkedArray)):
            return values if values.type == kind else values.cast(kind)
        return pa.array(values, type=kind)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = rows()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = function(batch.slice(start, ROWS_AT_ONCE))
                yield pa.RecordBatch.from_arrays([column(made[x.name], x.type) for x in types], schema=types)

    return df.mapInArrow(task, schema)


def to_arrow(schema: str) -> pa.Schema:
    """The Arrow schema of a schema given as text."""
    return to_arrow_schema(StructType.fromDDL(schema))
