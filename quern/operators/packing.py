"""Greedy packing in order, for groups of any size: segments are functions that are composed by doubling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.operators.ranks import ranked

BATCH_CHARS, BATCH_ITEMS, ALONE = 5000, 2, 0.7
#: Rows of a segment: what one array holds.
SEGMENT = 4096


def batch_ends(sizes: np.ndarray, most: int, items: int, limit: float) -> np.ndarray:
    """For each item the index after the batch that would begin with it: the batch is a function of its first item alone."""
    n = len(sizes)
    total, each = np.concatenate([[0], np.cumsum(sizes)]), np.arange(n)
    large = sizes > limit
    # the first large item at or after each place ends a batch before it
    stop = np.minimum.accumulate(np.where(large, each, n)[::-1])[::-1]
    fit = np.searchsorted(total, total[:-1] + most, side="right") - 1
    ends = np.minimum(np.minimum(each + items, fit), stop)
    return np.maximum(ends, each + 1)


def begins(sizes: np.ndarray, own: int, entry: int, most: int, items: int, limit: float) -> list[int]:
    """Where batches begin among the first `own` items if one begins at `entry`, and where the first one beyond them does."""
    ends, out = batch_ends(sizes, most, items, limit), [entry]
    while out[-1] < own:
        out.append(int(ends[out[-1]]))
    return out


def composed(functions: DataFrame) -> DataFrame:
    """(_key, _segment, entry, batch) of functions (_key, _segment, leave, begun), numbered from 0 without gaps: where each
    segment is entered and how many batches began before, if the first is entered at 0.

    In round k a segment's function takes in those of the 2**k segments before what it already has."""
    most = functions.agg(F.max("_segment")).first()[0] or 0
    reach = 1
    while reach <= most:
        before = functions.select("_key", (F.col("_segment") + reach).alias("_segment"), F.col("leave").alias("leave0"), F.col("begun").alias("begun0"))
        both = functions.join(before, ["_key", "_segment"], "left")
        leave = F.transform("leave0", lambda e: F.get("leave", e.cast("int")))
        begun = F.zip_with("leave0", "begun0", lambda e, n: n + F.get("begun", e.cast("int")))
        functions = scratch.stored(both.select("_key", "_segment", F.coalesce(leave, "leave").alias("leave"), F.coalesce(begun, "begun").alias("begun")), "composed")
        reach *= 2
    after = functions.select("_key", (F.col("_segment") + 1).alias("_segment"), F.col("leave")[0].alias("entry"), F.col("begun")[0].alias("batch"))
    first = functions.where("_segment = 0").select("_key", "_segment", F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("batch"))
    return after.unionByName(first)


def pack_greedy(df: DataFrame, keys: list[str], order: str, size: str, most: int = BATCH_CHARS, items: int = BATCH_ITEMS, alone: float = ALONE, segment: int = SEGMENT) -> DataFrame:
    """Adds batch (from 0 within the keys): items fill a batch in order until the next would exceed `most` in size or `items`
    in number; an item larger than alone * most ends the batch before it and stands by itself.

    Where a batch ends depends on its first item alone, so a group need not be folded from its beginning. It is ranked and cut
    into segments of at least `items` rows. A batch that begins in a segment ends among the first `items` rows of the next, so a
    segment is a function of where it is entered: for each of `items` entries, where the next one is entered and how many batches
    begin. These small functions are composed by doubling, which tells where each segment is entered and with which batch number,
    and segments then number their own rows. A group has as many tasks as segments.

    `order` should be unique within the keys. Null sizes count as 0, sizes are not negative; null keys are a group of their own.
    An empty table gives an empty result."""
    length, limit = max(segment, items), most * alone
    sized = df.withColumns({"_size": F.coalesce(F.col(size), F.lit(0)).cast("double"), "_key": F.to_json(F.struct(*keys))})
    rows = ranked(sized, ["_key"], [F.col(order)], "_rank").withColumn("_segment", F.floor((F.col("_rank") - 1) / length))
    rows = scratch.stored(rows, "ranked")
    by = ["_key", "_segment"]
    own = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_rank", "_size", F.struct(*df.columns).alias("_row")))).alias("_rows"))
    # rows that a batch of the segment before may reach into
    tail = rows.where((F.col("_segment") > 0) & ((F.col("_rank") - 1) % length < items)).groupBy("_key", (F.col("_segment") - 1).alias("_segment"))
    tail = tail.agg(F.array_sort(F.collect_list(F.struct("_rank", "_size"))).alias("_tail"))
    sizes = lambda c: F.transform(F.coalesce(c, F.array()), lambda x: x["_size"])
    whole = own.join(tail, by, "left").select(*by, F.concat(sizes("_rows"), sizes("_tail")).alias("_sizes"), F.size("_rows").alias("_own"), F.transform("_rows", lambda x: x["_row"]).alias("_rows"))
    whole = scratch.stored(whole, "segments")

    @F.pandas_udf("leave array<long>, begun array<long>")
    def function(all_sizes: pd.Series, owns: pd.Series) -> pd.DataFrame:
        walks = [[begins(s, n, k, most, items, limit) for k in range(min(items, n + 1))] for s, n in zip(all_sizes, owns, strict=True)]
        return pd.DataFrame({"leave": [[w[-1] - n for w in ws] for ws, n in zip(walks, owns, strict=True)], "begun": [[len(w) - 1 for w in ws] for ws in walks]})

    @F.pandas_udf("array<long>")
    def numbers(all_sizes: pd.Series, owns: pd.Series, entries: pd.Series, batches: pd.Series) -> pd.Series:
        out = []
        for s, n, entry, batch in zip(all_sizes, owns, entries, batches, strict=True):
            starts = np.zeros(n, dtype=np.int64)
            starts[begins(s, n, int(entry), most, items, limit)[:-1]] = 1
            out.append(batch - 1 + np.cumsum(starts))
        return pd.Series(out)

    functions = scratch.stored(whole.select(*by, function("_sizes", "_own").alias("f")).select(*by, "f.*"), "functions")
    placed = whole.join(composed(functions), by).withColumn("_batches", numbers("_sizes", "_own", "entry", "batch"))
    each = placed.select(F.explode(F.arrays_zip(F.col("_rows").alias("row"), F.col("_batches").alias("batch"))).alias("_e"))
    return each.select("_e.row.*", "_e.batch")
