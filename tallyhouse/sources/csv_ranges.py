"""CSV files with line breaks in quoted cells, each read by many tasks.

A file is cut into byte ranges of lines as any text file is. A line ends a record if the quotes up to its end are even in number, so the
quotes of each range are counted first, and their sums over the ranges before it tell in which state a range begins. Most ranges
hold whole lines only, and are parsed as they are. In the others lines are put together by their number in the range, and a record
that goes over a border is put together from its pieces, one or two of each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import Keep
from tallyhouse.sources.csv import COPY_OPTIONS

RANGE = ["file", "at"]


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of files: file, at (where their byte range begins), line (rising in a range), value, odd (1 if its quotes are odd in number)."""
    read = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
        "value",
        F.pmod(quotes, F.lit(2)).cast("int").alias("odd"),
    )


def ranges(found: DataFrame) -> DataFrame:
    """Per byte range: whether it begins (``opens``) and ends (``ends``) inside a quoted cell, whether all its lines are ``plain`` records, its first line."""
    counted = found.groupBy(*RANGE).agg(F.bit_xor("odd").alias("odd"), F.max("odd").alias("broken"), F.min("line").alias("first"))
    so_far = F.pmod(F.sum("odd").over(Window.partitionBy("file").orderBy("at")), F.lit(2)).cast("int")
    stated = counted.withColumn("ends", so_far).withColumn("opens", F.pmod(F.col("ends") + F.col("odd"), F.lit(2)))
    return stated.select(*RANGE, "opens", "ends", "first", ((F.col("opens") == 0) & (F.col("broken") == 0)).alias("plain"))


def text_of(*order: str) -> Column:
    """The values of a group in order, with the line breaks that were between them."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(*order, "value")))
    return F.concat_ws("\n", F.transform(sorted_rows, lambda r: r["value"])).alias("value")


def put_together(found: DataFrame) -> DataFrame:
    """The records of ranges that are not plain: value, and whether it is ``wanted``, as a file's first one is not.

    ``number`` counts the records that begin in a range; lines of number 0 go on with the record that the range before left open.
    """
    in_range = Window.partitionBy(*RANGE)
    before = F.coalesce(F.sum("odd").over(in_range.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = F.when(F.pmod(before + F.col("opens"), F.lit(2)) == 0, 1).otherwise(0)
    numbered = found.withColumn("begins", begins).withColumn("number", F.sum("begins").over(in_range.orderBy("line")))
    pieces = numbered.groupBy(*RANGE, "ends", "number").agg(text_of("line"))
    pieces = pieces.withColumn("last", F.max("number").over(in_range))
    pieces = pieces.withColumn("border", (F.col("number") == 0) | ((F.col("number") == F.col("last")) & (F.col("ends") == 1)))
    header = (F.col("at") == 0) & (F.col("number") == 1)
    whole = pieces.where(~F.col("border")).select("value", (~header).alias("wanted"))
    # A border piece that begins a record is followed by those that go on with it.
    begun = F.sum(F.when(F.col("number") > 0, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("at", "number"))
    over = pieces.where("border").withColumn("record", begun).groupBy("file", "record").agg(text_of("at", "number"), F.min(~header).alias("wanted"))
    return whole.unionByName(over.select("value", "wanted"))


def checked(value: Column) -> Column:
    """A record, which fails where it has a line break outside of a quoted cell; quotes within an unquoted cell can bring that about."""
    cells = F.regexp_replace(F.replace(value, F.lit('""'), F.lit("")), r'(?<![^,])"[^"]*+"(?![^,])', "")
    fault = F.raise_error(F.concat(F.lit("line break or quote outside of a quoted cell: "), F.left(value, F.lit(200)))).cast("string")
    breaks = F.contains(value, F.lit("\n")) | F.contains(value, F.lit("\r"))
    return F.when(~breaks, value).when(F.rlike(cells, F.lit(r"[\r\n]")), fault).otherwise(value)


def read_csv_ranges(spark: SparkSession, path: str | list[str], schema: T.StructType, keep: Keep) -> DataFrame:
    """Read CSV files whose quoted cells may hold line breaks, by as many tasks as their bytes ask for.

    The rows are those of ``read_csv`` with ``multiline``. A cell that does not parse, a quoted cell that never ends, and a line break
    that a quote in the middle of a cell hides fail the load. Runs a job that counts quotes; ``keep`` writes what it found, a row per range.
    """
    found = lines(spark, path)
    stated = keep(ranges(found), "csv_ranges")
    last = stated.groupBy("file").agg(F.max_by("ends", "at").alias("ends"), F.min("plain").alias("plain"))
    worst = last.agg(F.min("plain"), F.min(F.when(F.col("ends") == 1, F.col("file")))).first()
    if worst[1] is not None:
        raise ValueError(f"{worst[1]}: a quoted cell never ends")
    placed = found.join(stated, RANGE)
    header = (F.col("at") == 0) & (F.col("line") == F.col("first"))
    records = placed.select("value", (F.col("plain") & ~header).alias("wanted"))
    if worst[0] is False:
        records = records.unionByName(put_together(placed.where(~F.col("plain"))))
    # Rows are left out by explode and not by a filter: a condition on parsed cells would else be moved below it, and parse headers.
    value = F.regexp_replace("value", "\r$", "")
    record = F.explode(F.when(F.col("wanted") & (F.trim(value) != ""), F.array(checked(value)))).alias("record")
    options = {**COPY_OPTIONS, "header": "false", "mode": "FAILFAST", "multiLine": "true"}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(record).select(F.from_csv("record", fields, options).alias("row")).select("row.*")
