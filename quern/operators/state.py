"""State between runs: upserts, watermarks, resume decisions, completion, retention. State tables are Parquet versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.dedup import first_of


def upsert(old: DataFrame, new: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """old and new together with one row for each key: the first in the `newest` order. Applying it twice changes nothing."""
    return first_of(old.unionByName(new, allowMissingColumns=True), keys, newest)


def newer_than(df: DataFrame, ts: str, watermark: Column) -> DataFrame:
    """Rows strictly after the watermark, oldest first; a null watermark takes all."""
    return df.where(watermark.isNull() | (F.col(ts) > watermark)).orderBy(ts)


def advance(delivered: DataFrame, ts: str, ok: str) -> DataFrame:
    """The next watermark: before the first failure if there is one, else the last time; failed rows are met again."""
    failed = F.min(F.when(~F.col(ok), F.col(ts)))
    good = F.max(F.when(F.col(ok), F.col(ts)))
    return delivered.agg(failed.alias("first_failure"), good.alias("last_success"), F.max(ts).alias("last")).select(
        F.when(F.col("first_failure").isNull(), F.col("last")).otherwise(F.col("first_failure") - F.expr("interval 1 microsecond")).alias("watermark")
    )


def resume(expected: DataFrame, done: DataFrame, group: str, key: str, ok: Column, strict: bool = False) -> DataFrame:
    """What has to be computed again: expected keys without a good result, or with strict every key of a group that lacks one."""
    joined = expected.join(done.select(F.col(key), ok.alias("_ok")), key, "left").withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    if strict:
        open_groups = joined.where(~F.col("_ok")).select(F.col(group).alias("_group")).distinct()
        return joined.join(open_groups, F.col(group).eqNullSafe(F.col("_group")), "left_semi").drop("_ok")
    return joined.where(~F.col("_ok")).drop("_ok")


def group_status(expected: DataFrame, done: DataFrame, group: str, key: str, ok: Column) -> DataFrame:
    """total, success, failed and complete (every key good) for each group."""
    joined = expected.join(done.select(F.col(key), ok.alias("_ok")), key, "left").withColumn("_ok", F.coalesce("_ok", F.lit(False)))
    return joined.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if("_ok").alias("success"), F.count_if(~F.col("_ok")).alias("failed"), F.bool_and("_ok").alias("complete"))


def live(df: DataFrame, expiry: str, now: Column) -> DataFrame:
    """Entries of a skip list that still hold."""
    return df.where(F.col(expiry) > now)


def expired(df: DataFrame, modified: str, now: Column, days: int) -> DataFrame:
    return df.where(F.col(modified) < now - F.make_dt_interval(F.lit(days)))


class StateTable:
    """A table in versions below one folder. A reader takes the newest complete version, so a lost writer leaves the last
    one in place, and a version may be computed from the one before although both are the same table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        root, fs = self._folder()
        if not fs.exists(root):
            return []
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(s.getPath().getName() for s in fs.listStatus(root) if fs.exists(path(s.getPath(), "_SUCCESS")))

    def read(self) -> DataFrame | None:
        versions = self.versions()
        return self.spark.read.parquet(f"{self.path}/{versions[-1]}") if versions else None

    def write(self, df: DataFrame) -> None:
        versions = self.versions()
        number = int(versions[-1].split("-")[0][1:]) + 1 if versions else 0
        df.write.parquet(f"{self.path}/v{number:09d}-{uuid.uuid4().hex[:8]}")

    def upsert(self, new: DataFrame, keys: list[str], newest: list[Column]) -> None:
        old = self.read()
        self.write(first_of(new, keys, newest) if old is None else upsert(old, new, keys, newest))

    def clear(self) -> None:
        old = self.read()
        if old is not None:
            self.write(old.limit(0))

    def vacuum(self, keep: int = 2) -> list[str]:
        """Removes all but the newest versions and returns their names."""
        root, fs = self._folder()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        gone = self.versions()[:-keep]
        for name in gone:
            fs.delete(path(root, name), True)
        return gone
