"""Outputs in groups that are whole or redone: a group that lacks a good result is computed anew, all of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quern.operators import state


def outputs(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What the table of outputs holds; an empty table of the same columns where there is none yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException:
        return like.limit(0)


def redo(expected: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], group: str, key: str, ok: Callable[[DataFrame], Column], empty: DataFrame) -> int:
    """Computes the groups of `expected` (group, key) that are not complete in the table at `path`, and returns how many rows they have.

    compute gives a row (the columns of `empty`, group and key among them) for each row it is asked for; ok tells from the table's
    rows whether a result is good. An open group's folder is replaced as a whole and other folders are not touched (dynamic
    partition overwrite), so a run that is interrupted leaves each group as it was or done, and a second run changes
    nothing. The group of a null name is left out, as a folder cannot have it."""
    spark = expected.sparkSession
    done = outputs(spark, path, empty)
    open_rows = state.resume(expected.where(F.col(group).isNotNull()), done.select(key, ok(done).alias("_good")), group, key, F.col("_good"), strict=True)
    n = open_rows.count()
    if n:
        result = compute(open_rows).select(*empty.columns)
        # the table is read until the new rows are written, and only the folders of its open groups are replaced
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)
    return n
