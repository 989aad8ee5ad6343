"""Exact deduplication as a stream with state that never expires.

Every row arrives as a digest of its normalised text, a stable identifier, and a locator: the file and row its text is
in. A stream over the arrivals keeps, on disk and by digest, how many rows there were and identifier and locator of the row that
stays; the state is read back with the state data source. Where a digest was hit again, whole texts are read again
and compared byte by byte. Should different texts share a digest, they are parted by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import kept
from tallyhouse.session import file_system, new_folder

#: State in an embedded database on the executors' disks, saved to the checkpoint folder with every batch.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    # A partition's database is closed and its local files go when its task has committed.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Rows for which the stream gets one more partition of state, up to the session's shuffle partitions; each is a database of its own.
ROWS_PER_PARTITION, LEAST_PARTITIONS = 250_000, 8
BLANKS = " \t\n\x0b\x0c\r"
ARRIVAL = "doc_id long, digest string, n_chars long, file string, row long"


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def normalised() -> Column:
    """The text without blanks, a null as empty."""
    return F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), BLANKS, "")


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with file and row of each of its rows; written to files first if it does not come from some."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
    try:
        return docs.select(*columns, *place)
    except AnalysisException:
        return kept(docs.select(*columns), "texts").select(*columns, *place)


def arrivals(located: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """One short row per text, in the form the stream takes."""
    length = F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    return located.select("doc_id", digest(normalised()).alias("digest"), length.alias("n_chars"), "file", "row")


def first_of_all() -> Column:
    """What is kept of a group: the row with most characters, then smallest identifier (none last), then first place."""
    return F.min(F.struct((-F.col("n_chars")).alias("order"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "file", "row"))


def absorb(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Let the stream take all arrivals in ``folder`` that it has not taken yet, then stop.

    The state in ``checkpoint`` is that of all arrivals there ever were, so a later call finds repeats of earlier texts. A call
    that was broken off goes on where it was. The first call decides on the number of partitions of the state.
    """
    rows = spark.read.schema(ARRIVAL).parquet(folder).count()  # from the files' footers
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = min(most, max(LEAST_PARTITIONS, -(-rows // ROWS_PER_PARTITION)))
    session = spark.newSession()  # settings of the state do not reach the caller's session
    for key, value in STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    stream = session.readStream.schema(ARRIVAL).parquet(folder)
    query = (
        stream.groupBy("digest")
        .agg(F.count("*"), first_of_all())
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def state_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of the stream: digest, number of rows, and the row that stays."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.digest", F.col("value.count").alias("n"), F.col("value.min").alias("first"))


def grouped(spark: SparkSession, located: DataFrame, store: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Every arrival of a store with its group, after the stream has taken those that are new."""
    absorb(spark, f"{store}/arrivals/*", f"{store}/state")
    rows = spark.read.schema(ARRIVAL).parquet(f"{store}/arrivals/*")
    # Columns of the state have the names of its functions; a written copy gives the join a size it knows.
    path = new_folder(spark, "groups")
    state_of(spark, f"{store}/state").write.parquet(path)
    groups = spark.read.parquet(path)
    # Whole texts are read again where a digest was hit. Equal ones of a task go on as one.
    texts = located.withColumn("content", normalised()).withColumn("digest", digest(F.col("content")))
    # At every size the texts go to the digests, not a list of digests to the texts; a hot digest is cut up at run time.
    hit = texts.join(groups.where("n > 1").select("digest").hint("merge"), "digest", "left_semi")
    contents = hit.select("digest", "content").distinct().groupBy("digest").agg(F.count("*").alias("contents"))
    shared = kept(contents.where("contents > 1").select("digest"), "shared")
    if shared.isEmpty():
        return rows.join(groups, "digest")
    # Different texts under one digest: their groups are made by content.
    apart = rows.join(shared, "digest", "left_semi").join(texts.select("file", "row", "content"), ["file", "row"])
    parted = apart.groupBy("digest", "content").agg(F.count("*").alias("n"), first_of_all().alias("first"))
    alone = rows.join(shared, "digest", "left_anti").join(groups, "digest")
    return alone.unionByName(apart.join(parted, ["digest", "content"]).drop("content"))


def verdicts(rows: DataFrame) -> DataFrame:
    stays = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return rows.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        stays.alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the row of its group that stays: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without blanks; a null text is an empty one. Of a group, the row with the most
    characters stays, then the one with the smallest doc_id, a missing one last, then the one first in its files, so exactly one.
    ``keep_id`` is null if that row has none. One row per input row, repeated rows included; other columns are not read. Long
    texts are compared whole. ``text_sha256`` is what ``digest`` gives for the text without blanks.

    A group of any size is one row per task before the shuffle of the stream, and one text per task before that of the texts.
    """
    spark, store = docs.sparkSession, new_folder(docs.sparkSession, "dedup")
    located = in_files(docs)
    arrivals(located, digest).write.parquet(f"{store}/arrivals/all")
    return verdicts(grouped(spark, located, store, digest))


def deduplicate_more(docs: DataFrame, store: str, batch: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``deduplicate`` of all batches that were ever given for the folder ``store``, ``docs`` being the one called ``batch``.

    Texts of the batch are copied to the store, for later hits to be compared with. A batch of a name that is there is not
    taken again, so a call that failed can be repeated; calls for one store follow one another.
    """
    spark = docs.sparkSession
    texts, taken = f"{store}/texts/{batch}", f"{store}/arrivals/{batch}"
    files, done = file_system(spark, f"{taken}/_SUCCESS")
    if not files.exists(done):
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").write.mode("overwrite").parquet(texts)
        arrivals(in_files(spark.read.parquet(texts)), digest).write.mode("overwrite").parquet(taken)
    return verdicts(grouped(spark, in_files(spark.read.parquet(f"{store}/texts/*")), store, digest))
