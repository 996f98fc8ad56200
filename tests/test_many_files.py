"""Scans of many small files: tasks by the number of cores, and each file read once."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern import scratch
from quern.plans import scans
from quern.sources import files, named


def test_small_files_share_tasks(spark):
    path = scratch.path(spark, "many")
    df = spark.range(150).select(F.format_string("a+b %d/%d é.txt", F.col("id") % 3, "id").alias("n"), F.format_string("ü%d\r\n\n", "id").alias("t"))
    named.write_files(df.coalesce(1), path, F.col("n"), F.col("t"))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")  # a partition for each file
    try:
        texts, found = files.whole_texts(spark, path), files.binary_files(spark, path, (".txt",))
        cores = spark.sparkContext.defaultParallelism
        assert texts.rdd.getNumPartitions() <= 2 * cores and found.rdd.getNumPartitions() <= 2 * cores
        plain = "file://" + path.removeprefix("file://") if not path.startswith("file:") else path
        assert {(r.path.replace("file:///", "file:/"), r.text) for r in texts.collect()} == {(f"{plain.replace('file:///', 'file:/')}/{r.n}", r.t) for r in df.collect()}
        assert found.count() == 150
    finally:
        spark.conf.set(key, before)


def test_rows_of_one_partition_are_written_by_many_tasks(spark):
    path = scratch.path(spark, "spread")
    made = named.write_files(spark.range(500).coalesce(1), path, F.format_string("%d.txt", "id"), F.lit("x"))
    assert made.count() == 500
    assert len(made.inputFiles()) > 1  # the manifest has a file for each task


def test_sorted_pages_do_not_read_their_files_again(spark, sf_dir):
    assert all(x.endswith(".parquet") for x in scans.page_files(spark, sf_dir).inputFiles())
