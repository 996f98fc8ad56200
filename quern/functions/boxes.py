"""Boxes on page images as Column expressions, and columns from a projection profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Named thresholds.
MIN_W, MIN_H, MIN_AREA, MIN_ASPECT, MAX_ASPECT = 80, 40, 5000, 0.1, 10.0
DRAFT_W, DRAFT_H, DRAFT_SHARE, DRAFT_AREA, DRAFT_MIN, DRAFT_MAX, HEADER_Y = 100, 60, 0.95, 12_000, 0.25, 4.0, 300
TINY_W, TINY_H = 50, 30
GRAPHIC_DENSITY = 0.12
GAP, GAP_WIDTH, COLUMN_WIDTH = 0.08, 20, 200
READER_HEIGHT = 768


def is_block(w: Column, h: Column, area: Column) -> Column:
    """A connected component that is large enough and not a line: all bounds are strict."""
    return (w > MIN_W) & (h > MIN_H) & (area > MIN_AREA) & (F.try_divide(w, h) > MIN_ASPECT) & (F.try_divide(w, h) < MAX_ASPECT)


def is_draft_block(w: Column, h: Column, y: Column, page_width: Column) -> Column:
    """The stricter early rule, which also leaves out page headers and full-width boxes."""
    ratio = F.try_divide(w, h)
    return (w > DRAFT_W) & (h > DRAFT_H) & (w < DRAFT_SHARE * page_width) & (w * h > DRAFT_AREA) & (ratio > DRAFT_MIN) & (ratio < DRAFT_MAX) & (y > HEADER_Y)


def crop_class(w: Column, h: Column, density: Column, is_text_skipped: Column) -> Column:
    """The first of tiny, graphic, text and ok that fits a crop."""
    return F.when((w < TINY_W) | (h < TINY_H), "tiny").when(density < GRAPHIC_DENSITY, "graphic").when(is_text_skipped, "text").otherwise("ok")


def reading_order(df: DataFrame, page: list[str], x: str = "x", y: str = "y", ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds block: the box's number from 1 on its page, from top to bottom, then left to right."""
    return df.withColumn("block", F.row_number().over(Window.partitionBy(*page).orderBy(y, x, *ties)))


def reader_scale(height: Column) -> Column:
    return F.least(F.lit(1.0), F.lit(float(READER_HEIGHT)) / height)


def columns(profile: DataFrame, image: list[str], x: str = "x", value: str = "value", gap: float = GAP, gap_width: int = GAP_WIDTH, column_width: int = COLUMN_WIDTH) -> DataFrame:
    """(image keys, x0, x1) of the columns between gaps in a projection profile with one row for each x from 0.

    A gap is a maximal run of at least gap_width places whose scaled value is under `gap`, and that ends before the right
    edge; what lies between gaps is a column if it is at least column_width wide."""
    w = Window.partitionBy(*image)
    low, high = F.min(value).over(w), F.max(value).over(w)
    flagged = profile.select(*image, x, ((F.col(value) - low) / (high - low + 1e-5) < gap).alias("_gap"), (F.max(x).over(w) + 1).alias("_width"))
    runs = flagged.where("_gap").withColumn("_run", F.col(x) - F.row_number().over(w.orderBy(x)))
    gaps = runs.groupBy(*image, "_run", "_width").agg(F.min(x).alias("_a"), (F.max(x) + 1).alias("_b"))
    gaps = gaps.where((F.col("_b") - F.col("_a") >= gap_width) & (F.col("_b") < F.col("_width")))
    edge = flagged.groupBy(*image).agg(F.max("_width").alias("_a")).withColumn("_b", F.col("_a"))
    cuts = gaps.select(*image, "_a", "_b").unionByName(edge.select(*image, "_a", "_b"))
    cuts = cuts.withColumn("x0", F.coalesce(F.lag("_b").over(w.orderBy("_a", "_b")), F.lit(0)))
    return cuts.where(F.col("_a") - F.col("x0") >= column_width).select(*image, "x0", F.col("_a").alias("x1"))
