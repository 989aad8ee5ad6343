"""Typed CSV ingest with the null rules of a bulk COPY."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# An unquoted empty cell is NULL, a quoted one is the empty string; a quote is
# escaped by doubling it and a backslash is an ordinary character. Spark reads an empty
# cell as nullValue, so that is text no file has.
COPY_OPTIONS = {"header": "true", "nullValue": "\x01\x00", "escape": '"', "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Read CSV files with a declared schema. A cell that does not parse fails the load.

    ``multiline`` allows line breaks inside quoted cells; such files cannot be split
    between tasks.
    """
    return (
        spark.read.schema(schema)
        .options(**COPY_OPTIONS)
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(path)
    )


def read_csv_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Read CSV files, keeping bad lines: (rows that parse, lines that do not)."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.schema(with_corrupt)
        .options(**COPY_OPTIONS)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multiline)
        .csv(path)
    )
    good = lines.filter(lines[CORRUPT].isNull()).drop(CORRUPT)
    bad = lines.filter(lines[CORRUPT].isNotNull())
    return good, bad


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV files that ``read_csv`` reads back to the same rows, blanks around a cell included."""
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(**options).csv(path)
