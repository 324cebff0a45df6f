"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; where it names none, as in tests, one is set for a local master."""
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set(_KEY, folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A folder for tables that nothing reads after the block, which deletes them."""
    folder = new_folder(spark, name)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once, in its own folder or below a given one, and read back."""
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, name: str, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most so many rows, for jobs that run inside and whose rows hold whole sets."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def short_batches(spark: SparkSession, n_bytes: int):
    """Arrow batches that end once they have so many bytes, for jobs that run inside and mix long and short rows."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", n_bytes)


def freed_shuffles(spark: SparkSession):
    """Jobs that run inside delete their shuffle files when they end, not when the driver happens to collect garbage."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
