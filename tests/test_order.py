"""Ranks, percentiles and packing of groups that are larger than a task, against windows and plain loops."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import packing, quantiles, ranks


def rows_of(spark, values, schema="k string, i long, x double"):
    return spark.createDataFrame(values, schema)


ODD = [None, math.nan, math.inf, -math.inf, 0.0, -1.0, 1e12, 5.0, 5.0, 5.0]


@pytest.mark.parametrize("order", [["x"], ["desc"], ["last"]])
def test_ranks_equal_a_window(spark, order):
    by = {"x": [F.col("x"), F.col("i")], "desc": [F.desc("x"), F.col("i")], "last": [F.col("x").asc_nulls_last(), F.desc("i")]}[order[0]]
    rng = random.Random(1)
    values = [(rng.choice(["a", "b", None]), i, rng.choice(ODD) if i % 3 else rng.gauss(0, 1)) for i in range(500)] + [("one", 1000, None)] + [("same", 2000 + i, 7.0) for i in range(50)]
    df = rows_of(spark, values)
    mine = {r.i: r["rank"] for r in ranks.ranked(df, ["k"], by).collect()}
    theirs = {r.i: r.n for r in df.select("i", F.row_number().over(Window.partitionBy("k").orderBy(*by)).alias("n")).collect()}
    assert mine == theirs
    assert ranks.ranked(df.limit(0), ["k"], by).count() == 0


def test_an_outlier_does_not_fill_a_range(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = rows_of(spark, [("a", i, float(i) if i else 1e12) for i in range(4000)])
        placed = df.repartitionByRange(8, "k", F.col("x")).groupBy(F.spark_partition_id()).count().collect()
        assert max(r[1] for r in placed) < 1500
        assert {r.i: r["rank"] for r in ranks.ranked(df, ["k"], [F.col("x")]).collect()} == {0: 4000, **{i: i for i in range(1, 4000)}}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def plain_p95(values):
    return max(values) if len(values) < 20 else statistics.quantiles(values, n=20)[-1]


@pytest.mark.parametrize("n", [1, 2, 19, 20, 21, 39, 40, 400])
def test_percentile_with_nulls(spark, n):
    rng = random.Random(n)
    values = [rng.choice([1.5, 2.5, rng.random() * 10]) for _ in range(n)]
    df = rows_of(spark, [(None, i, x) for i, x in enumerate(values)] + [(None, -1, None), ("empty", 1, None)])
    found = {r.k: r.p95 for r in quantiles.exclusive_p95(df, ["k"], "x").collect()}
    assert found["empty"] is None
    assert found[None] == pytest.approx(plain_p95(values), abs=1e-9)


@pytest.mark.parametrize("block", [20, 60, 4096])
def test_running_percentile(spark, block):
    rng = random.Random(block)
    groups = {"a": 333, None: 45, "few": 7, "twenty": 20}
    values = [(k, i, rng.choice([3.0, rng.random() * 100, rng.gauss(i, 5)])) for k, n in groups.items() for i in range(n)]
    rows = values + [("a", -5, None), ("none", 1, None)]
    rng.shuffle(rows)
    out = quantiles.running_p95(rows_of(spark, rows), ["k"], [F.col("i")], "x", block=block).collect()
    found = {(r.k, r.n): (r.mean, r.p95) for r in out}
    assert len(found) == len(out)
    wanted = {}
    for k, n in groups.items():
        own = [x for key, _, x in values if key == k]
        for m in sorted({*range(20, n + 1, 20), n}):
            wanted[k, m] = (pytest.approx(sum(own[:m]) / m, abs=1e-9), pytest.approx(plain_p95(own[:m]), abs=1e-9))
    assert found == wanted
    assert quantiles.running_p95(rows_of(spark, rows).limit(0), ["k"], [F.col("i")], "x").count() == 0


def plain_batches(sizes, most, items, limit):
    batch, used, count, out = -1, 0, items, []
    for n in sizes:
        if n > limit:
            batch, used, count = batch + 1, 0, items
        elif count >= items or used + n > most:
            batch, used, count = batch + 1, n, 1
        else:
            used, count = used + n, count + 1
        out.append(batch)
    return out


@pytest.mark.parametrize(("items", "segment"), [(2, 2), (2, 7), (5, 5), (5, 64), (1, 3)])
def test_packing_equals_the_fold(spark, items, segment):
    rng = random.Random(items * segment)
    groups = {"a": 201, None: 40, "one": 1, "even": segment * 4}
    values = [(k, i, float(rng.choice([0, 10, 400, 900, 1500, 2400, 3499, 3500, 3501, 6000]))) for k, n in groups.items() for i in range(n)]
    df = rows_of(spark, values).withColumn("batch_no", F.lit(1))
    df = df.withColumn("x", F.when(F.col("x") > 0, F.col("x")).cast("long"))
    out = packing.pack_greedy(df, ["k"], "i", "x", items=items, segment=segment)
    assert out.columns == [*df.columns, "batch"]
    found = {(r.k, r.i): r.batch for r in out.collect()}
    for k, n in groups.items():
        own = [x for key, _, x in values if key == k]
        assert [found[k, i] for i in range(n)] == plain_batches(own, 5000, items, 3500)
    assert packing.pack_greedy(df.limit(0), ["k"], "i", "x").count() == 0


def test_a_group_is_dealt_over_its_segments(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), F.lit(2000).alias("x"))
    plan = packing.pack_greedy(df, ["k"], "i", "x", segment=50)
    assert plan.groupBy("batch").count().agg(F.max("count")).first()[0] == 2
    seen = []
    real, packing.scratch.stored = packing.scratch.stored, lambda df, label, **o: seen.append((label, real(df, label, **o))) or seen[-1][1]
    try:
        packing.pack_greedy(df, ["k"], "i", "x", segment=50)
    finally:
        packing.scratch.stored = real
    segments = dict(seen)["segments"]
    assert segments.count() == 20 and segments.agg(F.max(F.size("_sizes"))).first()[0] <= 52


def test_blocks_go_to_python_a_few_at_once(spark):
    """A batch of Arrow rows would hold all of a task's blocks, however many; it is bounded by bytes."""
    import pandas as pd

    quantiles.few_blocks_at_once(spark)
    rows = spark.range(64, numPartitions=1).select(F.sequence(F.lit(0), F.lit(quantiles.BLOCK * 4)).alias("x"))
    sizes = [r.n for r in rows.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()]
    assert sum(sizes) == 64
    assert max(sizes) <= 32
