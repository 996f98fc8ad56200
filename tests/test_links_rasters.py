"""Links, rasters, paged sources and named files against plain Python."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import raster, resolve
from quern.sources import named, paged
from quern.streaming import incremental


def flooded(cells):
    left, out = set(cells), []
    while left:
        stack = [left.pop()]
        block = list(stack)
        while stack:
            x, y = stack.pop()
            for p in [(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if p in left:
                    left.remove(p)
                    stack.append(p)
                    block.append(p)
        xs, ys = zip(*block, strict=True)
        out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1, len(block)))
    return out


@pytest.mark.parametrize("share", [0.15, 0.4, 1.0])
def test_blocks_equal_flood_fill(spark, share):
    rng = random.Random(int(share * 100))
    cells = {(k, x, y) for k in (None, 1) for x in range(25) for y in range(25) if rng.random() < share}
    # a spiral: one long block
    cells |= {(7, x, y) for x in range(15) for y in range(15) if (x % 2 == 0 and 0 < y < 14) or (y == 0 and x % 4 == 1) or (y == 14 and x % 4 == 3)}
    rows = [*cells, *list(cells)[:20], (1, None, 3), (1, 3, None)]
    out = raster.blocks(spark.createDataFrame(rows, "k int, x int, y int"), ["k"]).collect()
    wanted = sorted([(k, *b) for k in (None, 1, 7) for b in flooded({(x, y) for i, x, y in cells if i == k})], key=str)
    assert sorted([tuple(r) for r in out], key=str) == wanted
    assert raster.blocks(spark.createDataFrame([], "k int, x int, y int"), ["k"]).count() == 0


def test_otsu_equals_the_plain_search(spark):
    rng = np.random.default_rng(4)
    images = {1: np.concatenate([rng.normal(60, 9, 300), rng.normal(180, 12, 500)]), 2: rng.uniform(0, 255, 400), 3: np.full(9, 77.0)}
    rows = [(k, int(v), 1) for k, x in images.items() for v in np.clip(x, 0, 255).astype(int)]
    found = {r.k: (r.threshold, r.density) for r in raster.otsu(spark.createDataFrame(rows, "k int, level int, n int"), ["k"]).collect()}
    for k, x in images.items():
        v = np.clip(x, 0, 255).astype(int)
        best = max(sorted(set(v.tolist())), key=lambda c: (round((v <= c).mean() * (v > c).mean() * (v[v <= c].mean() - v[v > c].mean()) ** 2, 9) if (v > c).any() else 0.0, -c))
        assert found[k] == (best, pytest.approx((v <= best).mean()))
    assert 60 < found[1][0] < 180 and found[3] == (77, 1.0)


def test_links_are_followed_once_and_no_deeper(spark):
    links = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d.pdf"), ("b", "b"), ("x", None), (None, "y"), ("a", "b")]
    starts = [(1, "a"), (2, "c"), (3, "zzz"), (4, None), (1, "a")]
    s, li = spark.createDataFrame(starts, "root int, url string"), spark.createDataFrame(links, "url string, target string")
    found = {(r.root, r.url): r.hops for r in resolve.reached(s, li, 2).collect()}
    assert found == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "c"): 0, (2, "a"): 1, (2, "d.pdf"): 1, (2, "b"): 2, (3, "zzz"): 0}
    rank = F.when(F.col("url").endswith(".pdf"), 0).when(F.col("url") == "b", 1)
    best = {r.root: (r.url, r.hops, r["rank"]) for r in resolve.resolved(s, li, rank, 2).collect()}
    assert best == {1: ("b", 1, 1), 2: ("d.pdf", 1, 0), 3: (None, None, None), 4: (None, None, None)}
    assert {r.root: r.url for r in resolve.resolved(s, li, rank, 3).collect()}[1] == "d.pdf"


def test_named_files(spark, tmp_path):
    rows = [("a/one.txt", "é\n"), ("two.bin", None), (None, "lost"), ("b/three.txt", "x" * 1000)]
    df = spark.createDataFrame(rows, "n string, c string")
    out = {r.name: r.bytes for r in named.write_files(df, str(tmp_path / "out"), F.col("n"), F.col("c")).collect()}
    assert out == {"a/one.txt": 3, "two.bin": 0, "b/three.txt": 1000}
    assert (tmp_path / "out/a/one.txt").read_text() == "é\n"
    named.write_files(df.where("n = 'two.bin'"), str(tmp_path / "out"), F.col("n"), F.lit("again"))  # replaced whole
    assert (tmp_path / "out/two.bin").read_text() == "again"
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".tmp")]


def test_paged_source(spark, tmp_path):
    paged.register(spark)
    folder, cache, cp, out = (tmp_path / x for x in ("pages", "cache", "cp", "out"))
    folder.mkdir()
    page = lambda k, items: (folder / f"page_{k}.json").write_text(json.dumps(items))
    read = lambda: sorted((r.id, r.name) for r in spark.read.format("paged").schema("id long, name string").option("cache", str(cache)).load(str(folder)).collect())
    assert read() == []
    page(1, [{"id": 1, "name": "a"}, {"id": 2, "more": 0}])
    page(3, [{"id": 4}])  # the second is still on its way
    assert read() == [(1, "a"), (2, None)]

    def run():
        stream = spark.readStream.format("paged").schema("id long, name string").load(str(folder))
        stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(cp)).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.id for r in spark.read.schema("id long").parquet(str(out)).collect())

    assert run() == [1, 2]
    page(2, [])
    assert run() == [1, 2, 4]
    assert run() == [1, 2, 4]
    page(1, [{"id": 9, "name": "new"}])  # another version is read anew, the old one stays in the cache
    assert read() == [(4, None), (9, "new")]
    assert len([f for f in os.listdir(cache) if f.startswith("page_1-")]) == 2


def test_taken_files_are_moved(spark, tmp_path):
    src, old = tmp_path / "in", tmp_path / "old"
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(src))
        stream = incremental.archiving_stream(spark, str(src), "id long", str(old))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(30))
    moved = [f for _, _, names in os.walk(old) for f in names if f.endswith(".parquet")]
    left = [f for f in os.listdir(src) if f.endswith(".parquet")]
    assert len(moved) + len(left) == 3 and len(moved) >= 2
