"""Structured Streaming forms of the batch operators: seen-set deduplication, token buckets and page completion."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.operators.ratelimit import Bucket, Limits


def file_stream(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def archiving_stream(spark: SparkSession, path: str, schema: str, archive: str, files_at_once: int = 100) -> DataFrame:
    """A file stream that moves each file to the archive, under its own path there, once the batch that took it is done."""
    cleaned = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return cleaned.parquet(path)


def first_seen(stream: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Each key once within the lateness that state is kept for."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str, late: str) -> DataFrame:
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"))


def token_bucket(stream: DataFrame, key: str, ts: str, event_id: str, limits: Limits = Limits()) -> DataFrame:
    """(key, event_id, decision): the batch operator's fold with the bucket as state. Rows of one micro-batch are taken in
    order of time and id; across batches they must arrive in order, as in any rate limiter."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        bucket = Bucket(limits, *kept.get) if kept.exists else Bucket(limits)
        rows = pd.concat(list(frames)).sort_values(["_s", "event_id"])
        yield pd.DataFrame({"key": k[0], "event_id": rows["event_id"], "decision": [bucket.ask(s) for s in rows["_s"]]})
        kept.update((bucket.tokens, bucket.refilled, bucket.day, bucket.used, bucket.blocked_until))

    timed = stream.select(F.col(key).alias("key"), F.col(event_id).alias("event_id"), (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6).alias("_s"))
    return timed.groupBy("key").applyInPandasWithState(run, "key long, event_id long, decision string", "tokens double, refilled double, day long, used long, blocked double", "append", GroupStateTimeout.NoTimeout)


def page_completions(stream: DataFrame) -> DataFrame:
    """(page, blocks) once, when as many distinct blocks as expected have arrived. Input: page string, block long, expected long."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        done, seen = (kept.get[0], set(kept.get[1])) if kept.exists else (False, set())
        expected = 0
        for frame in frames:
            seen |= set(frame["block"].tolist())
            expected = max(expected, int(frame["expected"].max()))
        if not done and len(seen) >= expected:
            done = True
            yield pd.DataFrame({"page": [k[0]], "blocks": [len(seen)]})
        kept.update((done, [] if done else sorted(seen)))  # a page that is done keeps no set

    return stream.groupBy("page").applyInPandasWithState(run, "page string, blocks long", "done boolean, seen array<long>", "append", GroupStateTimeout.NoTimeout)


def deliver(stream: DataFrame, checkpoint: str, send: Callable[[DataFrame, int], None]) -> None:
    """Hands every new batch to `send`, at least once, and returns when there is nothing new."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(send).start().awaitTermination()
