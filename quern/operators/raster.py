"""Rasters as tables of cells: connected blocks, and Otsu's threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern import scratch


def blocks(cells: DataFrame, image: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """(image keys, x0, y0, x1, y1, area) of the blocks of cells that touch at a side or a corner; x1 and y1 lie beyond the last cell.

    cells has one row for each set cell (repeated rows count once). Cells that follow each other in a row of the image become a run, so
    what is joined is runs: those of neighbouring rows that overlap, or meet at a corner, are linked. A block has the least of
    its runs' names, which spreads by pointer doubling: in each round a run takes the least name among its own, its neighbours'
    and that of the run it is named after. Rounds are stored; they grow with the logarithm of a block's length in runs where names
    run downwards, and end when no name changes."""
    cells = cells.select(*image, F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y")).na.drop(subset=["x", "y"]).distinct()
    row = Window.partitionBy(*image, "y").orderBy("x")
    runs = cells.withColumn("_run", F.col("x") - F.row_number().over(row)).groupBy(*image, "y", "_run").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count(F.lit(1)).alias("n"))
    key = F.to_json(F.struct(*image)) if image else F.lit("")
    runs = scratch.stored(runs.select(*image, key.alias("_image"), "y", "a", "b", "n", F.monotonically_increasing_id().alias("id")), "runs")
    above = runs.select("_image", (F.col("y") + 1).alias("y"), F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("id").alias("other"))
    links = runs.join(above, ["_image", "y"]).where("a <= b0 + 1 and b >= a0 - 1").select("id", "other")
    links = scratch.stored(links.unionByName(links.select(F.col("other").alias("id"), F.col("id").alias("other"))), "links")
    names = scratch.stored(runs.select("id", F.col("id").alias("name")), "names")
    while True:
        of = names.select(F.col("id").alias("other"), F.col("name").alias("theirs"))
        least = links.join(of, "other").groupBy("id").agg(F.min("theirs").alias("theirs"))
        nearer = names.join(least, "id", "left").select("id", "name", F.least("name", "theirs").alias("new"))
        # the name of the run that one is named after, and that run in turn learns of the smaller name
        hop = scratch.stored(nearer, "nearer")
        jump = hop.join(hop.select(F.col("id").alias("new"), F.col("new").alias("further")), "new").select("id", "name", F.least("new", "further").alias("new"))
        told = hop.groupBy(F.col("name").alias("id")).agg(F.min("new").alias("told"))
        changed = scratch.stored(jump.join(told, "id", "left").select("id", "name", F.least("new", "told").alias("new")), "names")
        names = changed.select("id", F.col("new").alias("name"))
        if changed.where("new < name").isEmpty():
            break
    out = runs.join(names, "id").groupBy("name", *image).agg(F.min("a").alias("x0"), F.min("y").alias("y0"), (F.max("b") + 1).alias("x1"), (F.max("y") + 1).alias("y1"), F.sum("n").alias("area"))
    return out.select(*image, "x0", "y0", "x1", "y1", "area")


def otsu(histogram: DataFrame, image: list[str], level: str = "level", n: str = "n") -> DataFrame:
    """(image keys, threshold, density): the level up to which pixels are dark so that the variance between the two classes is
    largest (the smallest on ties), and the share of dark pixels. histogram has one row for each image and level (256 by its
    meaning), with its number of pixels. An image of one level has that as threshold and a density of 1."""
    w = Window.partitionBy(*image)
    upto = w.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    n0, s0 = F.sum(n).over(upto), F.sum(F.col(n) * F.col(level)).over(upto)
    total, weight = F.sum(n).over(w), F.sum(F.col(n) * F.col(level)).over(w)
    sums = histogram.groupBy(*image, level).agg(F.sum(n).cast("double").alias(n)).withColumns({"_n0": n0, "_s0": s0, "_n": total, "_s": weight})
    n1 = F.col("_n") - F.col("_n0")
    apart = F.try_divide(F.col("_s0"), F.col("_n0")) - F.try_divide(F.col("_s") - F.col("_s0"), n1)
    between = F.coalesce(F.round(F.col("_n0") / F.col("_n") * (n1 / F.col("_n")) * apart * apart, 9), F.lit(0.0))
    best = F.row_number().over(w.orderBy(F.desc("_between"), level))
    found = sums.withColumn("_between", between).withColumn("_best", best).where("_best = 1")
    return found.select(*image, F.col(level).alias("threshold"), (F.col("_n0") / F.col("_n")).alias("density"))


def is_graphic(density: Column, least: float = 0.12) -> Column:
    return density < least
