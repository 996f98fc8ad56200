"""Small joins and orders: rows without a partner, positional pairs, first places, inserts at the front, the newest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without_partner(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key does not occur in other."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def zipped(left: DataFrame, right: DataFrame, position: list[str]) -> DataFrame:
    """Pairs of rows at the same position; what one side alone has is left out."""
    return left.join(right, position)


def first_place(df: DataFrame, keys: list[str], place: list[str]) -> DataFrame:
    """The least place (columns in order) of each key."""
    found = df.groupBy(*keys).agg(F.min(F.struct(*place)).alias("_m"))
    return found.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in place])


def front_inserts(df: DataFrame, keys: list[str], urgent: Column, arrival: str, out: str = "place") -> DataFrame:
    """Adds the place in a queue: urgent rows go to the front one after the other, which turns their order round; the rest
    keep theirs."""
    turned = F.when(urgent, -F.col(arrival)).otherwise(F.col(arrival))
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(F.when(urgent, 0).otherwise(1), turned)))


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of an order, as a top-k: no full sort."""
    return df.orderBy(*order).limit(n)


def fresh_missing(wanted: DataFrame, present: DataFrame, key: str, day: Column, today: Column, valid: Column) -> DataFrame:
    """Wanted rows without a valid file of today among those present."""
    return without_partner(wanted, present.where((day == today) & valid), key)


def batch_outcome(prompts: DataFrame, results: DataFrame, position: list[str], response: str, default: str = "") -> DataFrame:
    """Results padded to the prompts' number: every prompt with its response, or the default, and whether there was one."""
    found = results.select(*position, F.col(response).alias("_response"))
    out = prompts.join(found, position, "left")
    return out.withColumns({"succeeded": F.coalesce(F.length("_response") > 0, F.lit(False)), response: F.coalesce("_response", F.lit(default))}).drop("_response")
