"""Tables that are written in the shared folder and read back: lineage ends there and a lost executor costs nothing."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Row groups of scratch tables: what a writing task holds in memory.
ROW_GROUP_BYTES = str(32 << 20)


def root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that setting is missing, a temporary folder of our own on a local
    master; on a cluster every machine would see another one, so that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = f"file://{tempfile.mkdtemp(prefix='quern-scratch-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder. It is removed by clear() or when the driver's process ends."""
    made = f"{root(spark)}/quern-{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(clear, spark)
    _made.append(made)
    return made


_made: list[str] = []


def clear(spark: SparkSession) -> None:
    """Removes all scratch of this process. Results that were not written yet may read it, so write them first."""
    while _made:
        remove(spark, _made.pop())


def remove(spark: SparkSession, where: str) -> None:
    """Deletes a scratch path through Hadoop's file system; a stopped session or a missing path is no error."""
    if spark.sparkContext._jsc is None:
        return
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def folder(spark: SparkSession, where: str) -> None:
    """Makes a folder through Hadoop's file system, so that a scan finds it though no row was written there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back."""
    spark = df.sparkSession
    where = path(spark, label)
    df.write.options(**{"parquet.block.size": ROW_GROUP_BYTES, **options}).parquet(where)
    return spark.read.schema(df.schema).parquet(where)
