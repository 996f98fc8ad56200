"""Window-like operators: word windows, chunks, splits, greedy packing, runs and neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators.packing import pack_greedy  # noqa: F401  (belongs with the windows)
from quern.operators.ranks import ranked

WIDTH, OVERLAP = 1000, 50
HYBRID_CHARS = 3000


def word_windows(df: DataFrame, text: str, width: int = WIDTH, overlap: int = OVERLAP, drop_covered_tail: bool = False) -> DataFrame:
    """A row for each overlapping window of words: batch_no (from 1), word_start, n_words and text; blank texts give none.

    A text of at most `width` words is one window. A last window may lie wholly within the one before;
    drop_covered_tail leaves those out. Other columns pass through; nothing is shuffled."""
    step = width - overlap
    w = df.withColumn("_w", T.words(F.col(text)))
    n = F.size("_w")
    last = F.when(n <= width, 0).otherwise((n - overlap - 1 if drop_covered_tail else n - 1)).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(step))
    # windows are cut before they are exploded, so no row carries a whole page's words
    cut = F.transform(starts, lambda s: F.struct(s.alias("word_start"), F.least(F.lit(width), n - s).alias("n_words"), F.array_join(F.slice("_w", s + 1, width), " ").alias("text")))
    kept = [c for c in df.columns if c != text]
    out = w.select(*kept, F.posexplode(F.when(n > 0, cut)).alias("_no", "_win"))
    return out.select(*kept, (F.col("_no") + 1).alias("batch_no"), "_win.word_start", "_win.n_words", F.col("_win.text").alias(text))


def chunk_numbers(df: DataFrame, keys: list[str], order: list[Column], size: int) -> DataFrame:
    """Adds pos (from 1) and chunk (from 0) of `size` rows each within the keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("pos", F.row_number().over(w)).withColumn("chunk", F.floor((F.col("pos") - 1) / size).cast("long"))


def ratio_split(df: DataFrame, keys: list[str], order: list[Column], numerator: int = 2, denominator: int = 3, ranged: bool = False) -> DataFrame:
    """Adds side: "first" for the first floor(n * numerator / denominator) rows of the keys, "second" for the rest.

    With `ranged`, large groups are ranked by many tasks."""
    if not ranged:
        w = Window.partitionBy(*keys)
        take = F.floor(F.count(F.lit(1)).over(w) * numerator / denominator)
        return df.withColumn("side", F.when(F.row_number().over(w.orderBy(*order)) <= take, "first").otherwise("second"))
    takes = df.groupBy(*keys).agg(F.floor(F.count(F.lit(1)) * numerator / denominator).alias("_take"))
    out = with_group_values(ranked(df, keys, order, "_rank"), takes, keys)
    return out.withColumn("side", F.when(F.col("_rank") <= F.col("_take"), "first").otherwise("second")).select(*df.columns, "side")


def with_group_values(df: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns that values has for its group. Few groups are broadcast by their size at run time."""
    named = values.select(*[F.col(c).alias(f"_key_{c}") if c in keys else F.col(c) for c in values.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return df.join(named, same).drop(*[f"_key_{k}" for k in keys])


def next_in_order(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str = "next_item") -> DataFrame:
    """Adds the value of the row that follows; "" (as text) at the end."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.coalesce(F.lead(F.col(value).cast("string")).over(w), F.lit("")))


def runs_where(df: DataFrame, keys: list[str], order: list[Column], condition: Column, least: int = 1) -> DataFrame:
    """Maximal runs of consecutive rows that satisfy the condition, of at least `least` rows: keys, first_pos, last_pos, length."""
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumns({"_pos": F.row_number().over(w).cast("long"), "_hit": F.coalesce(condition, F.lit(False))})
    hits = numbered.where("_hit").withColumn("_island", F.col("_pos") - F.row_number().over(Window.partitionBy(*keys).orderBy("_pos")))
    out = hits.groupBy(*keys, "_island").agg(F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"), F.count(F.lit(1)).alias("length"))
    return out.where(F.col("length") >= least).drop("_island")


def route_by_size(size: Column, limit: int = HYBRID_CHARS) -> Column:
    return F.when(size > limit, "gpu").otherwise("cpu")


def numbered_lines(df: DataFrame, keys: list[str], order: list[Column], text: str) -> DataFrame:
    """Adds line: "<n>. <text>", numbered from 1 within the keys."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("line", F.concat(F.row_number().over(w).cast("string"), F.lit(". "), F.col(text)))


def min_max_scaled(df: DataFrame, keys: list[str], value: str, epsilon: float = 1e-9) -> DataFrame:
    """Adds scaled, the value's place between its group's least and greatest. Groups are aggregated, not gathered."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    out = with_group_values(df, ends, keys)
    return out.withColumn("scaled", (F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low") + epsilon)).drop("_low", "_high")
