"""Streams give what the batch operators give."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quern.operators import ratelimit
from quern.streaming import incremental


def run(stream, name):
    q = stream.writeStream.outputMode("append").format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return stream.sparkSession.table(name)


SCHEMA = "user_id long, event_id long, ts timestamp"


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in")
    return f"{tmp_path}/in"


def test_token_bucket(spark, tmp_path):
    rows = [(k, 10 * k + i, dt.datetime(2024, 1, 1, 0, 0, i)) for k in range(3) for i in range(8)]
    path = written(spark, tmp_path, rows)
    out = run(incremental.token_bucket(incremental.file_stream(spark, path, SCHEMA), "user_id", "ts", "event_id"), "bucket")
    batch = ratelimit.token_bucket(spark.read.parquet(path), "user_id", "ts", "event_id")
    assert sorted((r.event_id, r.decision) for r in out.collect()) == sorted((r.event_id, r.decision) for r in batch.collect())


def test_first_seen_and_delivery(spark, tmp_path):
    path = written(spark, tmp_path, [(1, 1, dt.datetime(2024, 1, 1)), (1, 2, dt.datetime(2024, 1, 1)), (2, 3, dt.datetime(2024, 1, 1))])
    assert run(incremental.first_seen(incremental.file_stream(spark, path, SCHEMA), "user_id", "ts"), "seen").count() == 2
    sent = []
    for _ in range(2):
        incremental.deliver(incremental.file_stream(spark, path, SCHEMA), f"{tmp_path}/cp", lambda df, _: sent.append(df.count()))
    assert sent == [3]


def test_page_completion(spark, tmp_path):
    spark.createDataFrame([("p", 1, 2), ("p", 2, 2), ("q", 1, 2)], "page string, block long, expected long").write.parquet(f"{tmp_path}/blocks")
    stream = spark.readStream.schema("page string, block long, expected long").parquet(f"{tmp_path}/blocks")
    assert [tuple(r) for r in run(incremental.page_completions(stream), "pages_done").collect()] == [("p", 2)]


def test_windowed_counts(spark, tmp_path):
    path = written(spark, tmp_path, [(1, i, dt.datetime(2024, 1, 1, 0, i)) for i in range(30)] + [(1, 99, dt.datetime(2024, 1, 2))])
    out = run(incremental.windowed_counts(incremental.file_stream(spark, path, SCHEMA), "ts", "user_id", "10 minutes", "1 minute"), "counted")
    assert [r.n for r in out.orderBy(F.col("window.start")).collect()][:3] == [10, 10, 10]
