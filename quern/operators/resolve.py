"""Links followed to the document that they lead to, level by level, over stored pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.operators.dedup import first_of


def reached(starts: DataFrame, links: DataFrame, depth: int = 3) -> DataFrame:
    """(root, url, hops): every url that a root's start reaches over at most `depth` links, with the fewest links.

    starts has (root, url), links (url, target), one row for each link of a stored page. Each step joins the urls that were new in
    the last one with the links, and drops what the root has seen, so a cycle ends and a url is met once; steps are stored. Null
    urls and targets are left out, repeated rows count once."""
    frontier = scratch.stored(starts.where("url is not null").select("root", "url").distinct().withColumn("hops", F.lit(0)), "frontier")
    seen = frontier
    links = scratch.stored(links.where("url is not null and target is not null").select("url", "target").distinct(), "links")
    for k in range(1, depth + 1):
        if frontier.isEmpty():
            break
        ahead = frontier.select("root", "url").join(links, "url").select("root", F.col("target").alias("url")).distinct()
        frontier = scratch.stored(ahead.join(seen.select("root", "url"), ["root", "url"], "left_anti").withColumn("hops", F.lit(k)), "frontier")
        seen = seen.unionByName(frontier)
    return seen


def resolved(starts: DataFrame, links: DataFrame, rank: Column, depth: int = 3) -> DataFrame:
    """(root, url, hops, rank): for each root the url to take. rank is an expression of url: the smallest is the best kind, null
    rules a url out. Of equal rank the nearest stays, then the first by name; a root without a usable url has nulls."""
    found = reached(starts, links, depth).withColumn("rank", rank).where("rank is not null")
    best = first_of(found, ["root"], [F.col("rank"), F.col("hops"), F.col("url")])
    return starts.select("root").distinct().join(best, "root", "left").select("root", "url", "hops", "rank")
