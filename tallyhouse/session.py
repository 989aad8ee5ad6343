"""Session settings the library is written for, and tables written along the way."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # A key with very many rows is cut up at run time, on the side of a join that has them.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join whose shuffled partitions turn out small is hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.ui.enabled": "false",
}

Keep = Callable[[DataFrame, str], DataFrame]


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter builds the session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyhouse")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if folder:
        builder = builder.config("spark.checkpoint.dir", folder)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A session on one machine that names none uses a folder in its warehouse; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_folder(spark: SparkSession, name: str = "run") -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as an object of it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    files, target = file_system(spark, path)
    files.delete(target, True)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For a result that several steps use: it is computed once, survives a lost
    executor, and has a size Spark knows when it plans the next join. Runs a job.
    The files stay for as long as the result may be read; see ``scratch``.
    """
    return _written(df, new_folder(df.sparkSession, name))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Keep]:
    """A ``staged`` whose files are removed when the block ends."""
    folder = new_folder(spark, "scratch")
    try:
        yield lambda df, name: _written(df, f"{folder}/{name}-{uuid.uuid4().hex}")
    finally:
        remove(spark, folder)
