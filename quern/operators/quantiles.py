"""The 95th percentile by the exclusive rule: of whole groups, and of every prefix of a group that is a multiple of some rows.

Of n >= 20 values in order it is ((20 - d) * x[j] + d * x[j + 1]) / 20 with j = floor(19 * (n + 1) / 20) and d the
remainder, j kept between 1 and n - 1; of fewer, the greatest.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern import scratch
from quern.operators.ranks import ranked

PARTS, EVERY = 20, 20
#: Rows of a block of time, of a range of values and of a block of questions.
BLOCK = 1 << 14
#: Bytes of the Arrow batches in which blocks, one a row, go to Python: some ten of them.
BATCH_BYTES = 4 << 20


def few_blocks_at_once(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes (a smaller one, or one set with a unit, stays), as their rows alone bound nothing where a row is a block."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = spark.conf.get(key).rstrip("bB")
    if found.isdigit() and int(found) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def places(n: Column) -> tuple[Column, Column]:
    """(j, d) of groups of n values."""
    j = F.least(F.greatest(F.floor((PARTS - 1) * (n + 1) / PARTS), F.lit(1)), F.greatest(n - 1, F.lit(1)))
    return j, ((PARTS - 1) * (n + 1)) % PARTS


def interpolated(n: Column, at_j: Column, after: Column, greatest: Column) -> Column:
    d = places(n)[1]
    return F.when(n < PARTS, greatest).otherwise((at_j * (PARTS - d) + after * d) / PARTS)


def exclusive_p95(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, p95) of each group; nulls are not counted, a group without values has a null p95."""
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_n"), F.max(value).alias("_greatest"))
    numbered = ranked(df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value")), keys, [F.col("_value")], "_rank")
    j = places(F.col("_n"))[0]
    named = sizes.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_n", "_greatest")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    at = lambda place: F.max(F.when(F.col("_rank") == place, F.col("_value")))
    # the two values of each group are picked where they lie; groups without any come back by the sizes
    picked = numbered.join(named, same).where((F.col("_rank") == j) | (F.col("_rank") == j + 1))
    picked = picked.groupBy(*[f"_key_{k}" for k in keys]).agg(at(j).alias("_a"), at(j + 1).alias("_b"))
    found = named.alias("n").join(picked.select(*[F.col(f"_key_{k}").alias(k) for k in keys], "_a", "_b"), same, "left")
    return found.select(*[F.col(f"_key_{k}").alias(k) for k in keys], interpolated(F.col("_n"), F.col("_a"), F.col("_b"), F.col("_greatest")).alias("p95"))


def running_p95(df: DataFrame, keys: list[str], order: list[Column], value: str, every: int = EVERY, block: int = BLOCK) -> DataFrame:
    """(keys, n, mean, p95) of the first `every`, 2 * `every`, ... values of each group in the given order, and of all of them.

    Each value gets its place in time and its rank among its group's values. Ranks are cut into ranges of `block` values and time
    into blocks of `block` rows, so a group is a table of counts, (block, range), whose running sums say how many values of
    each range stand before each block. A task has one block of time and those sums: for each prefix that ends there it finds the
    range that holds the wanted value, and its place among the range's values so far. A second task has one range and as many
    such questions as a block has rows: it puts the range's values in order of time into a sorted list and reads the
    places. No task holds more than a few blocks, whatever a group's size; rows travel three times.

    `order` should be unique within the keys. Null values are left out and not counted, null keys are a group. An empty table
    gives an empty result."""
    few_blocks_at_once(df.sparkSession)
    block = -(-block // every) * every
    rows = df.where(F.col(value).isNotNull()).select(F.to_json(F.struct(*keys)).alias("_key"), *keys, F.col(value).cast("double").alias("_value"), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    times = ranked(rows, ["_key"], [F.col(f"_o{i}") for i in range(len(order))], "_t").select("_key", *keys, "_value", "_t")
    both = ranked(times, ["_key"], [F.col("_value"), F.col("_t")], "_v")
    both = scratch.stored(both.withColumns({"_block": F.floor((F.col("_t") - 1) / block), "_range": F.floor((F.col("_v") - 1) / block)}), "places")
    names = both.groupBy("_key").agg(F.count(F.lit(1)).alias("_all"), F.max("_range").alias("_ranges"), *[F.first(k).alias(k) for k in keys])
    names = scratch.stored(names, "groups")

    # what stands before each block: one row for each of a group's blocks and ranges that occur together, summed over time
    counts = both.groupBy("_key", "_block", "_range").agg(F.count(F.lit(1)).alias("n"), F.sum("_value").alias("total"))
    tally = counts.groupBy("_key", "_block").agg(F.collect_list(F.struct("_range", "n")).alias("counts"), F.sum("total").alias("total"))
    before = _before(scratch.stored(tally.join(names.select("_key", "_ranges"), "_key"), "tally"))
    timed = both.groupBy("_key", "_block").agg(F.array_sort(F.collect_list(F.struct("_t", "_value", "_range"))).alias("_rows"))
    ready = timed.join(before, ["_key", "_block"]).join(names.select("_key", "_all"), "_key")
    schema = "_key string, n long, mean double, place int, _range long, at long"

    def locate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):
                seen, total, out = np.array(r["seen"], dtype=np.int64), r["sum_before"], []
                for k, x in enumerate(r["_rows"]):
                    seen[int(x["_range"])] += 1
                    total += x["_value"]
                    n = r["_block"] * block + k + 1
                    if n % every and n != r["_all"]:
                        continue
                    upto = np.cumsum(seen)
                    j = min(max((PARTS - 1) * (n + 1) // PARTS, 1), max(n - 1, 1))
                    for place, want in ((0, j), (1, min(j + 1, n))) if n >= PARTS else ((1, n),):
                        at = int(np.searchsorted(upto, want))
                        out.append((r["_key"], n, total / n, place, at, want - (int(upto[at - 1]) if at else 0)))
                if out:
                    yield pd.DataFrame(out, columns=["_key", "n", "mean", "place", "_range", "at"])

    asked = scratch.stored(ready.select("_key", "_block", "_rows", "seen", "sum_before", "_all").mapInPandas(locate, schema), "asked")
    part = F.floor(F.col("n") / (block * every))
    questions = asked.withColumn("_part", part).groupBy("_key", "_range", "_part").agg(F.array_sort(F.collect_list(F.struct("n", "place", "at", "mean"))).alias("_asked"))
    values = both.groupBy("_key", "_range").agg(F.array_sort(F.collect_list(F.struct("_t", "_value"))).alias("_rows"))

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.to_dict("records"):
                kept, k, out = [], 0, []
                for q in r["_asked"]:
                    while k < len(r["_rows"]) and r["_rows"][k]["_t"] <= q["n"]:
                        insort(kept, r["_rows"][k]["_value"])
                        k += 1
                    out.append((r["_key"], q["n"], q["place"], q["mean"], kept[q["at"] - 1]))
                yield pd.DataFrame(out, columns=["_key", "n", "place", "mean", "found"])

    found = questions.join(values, ["_key", "_range"]).select("_key", "_asked", "_rows").mapInPandas(answer, "_key string, n long, place int, mean double, found double")
    at = lambda k: F.max(F.when(F.col("place") == k, F.col("found")))
    pairs = found.groupBy("_key", "n").agg(F.max("mean").alias("mean"), at(0).alias("_a"), at(1).alias("_b"))
    p95 = interpolated(F.col("n"), F.col("_a"), F.col("_b"), F.col("_b"))
    return pairs.join(names.select("_key", *keys), "_key").select(*keys, "n", "mean", p95.alias("p95"))


def _before(tally: DataFrame) -> DataFrame:
    """(_key, _block, seen, sum_before): counts of each range, and the sum of values, of all blocks before. By doubling: in each
    round a block's sums take in those of as many blocks before as they already hold."""
    dense = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_ranges")), lambda r: F.coalesce(F.get(F.filter("counts", lambda c: c["_range"] == r), F.lit(0))["n"], F.lit(0).cast("long")))
    sums = scratch.stored(tally.select("_key", "_block", dense.alias("seen"), F.col("total").alias("sum_before")), "sums")
    most, reach = sums.agg(F.max("_block")).first()[0] or 0, 1
    while reach <= most:
        earlier = sums.select("_key", (F.col("_block") + reach).alias("_block"), F.col("seen").alias("seen0"), F.col("sum_before").alias("sum0"))
        joined = sums.join(earlier, ["_key", "_block"], "left")
        seen = F.coalesce(F.zip_with("seen", "seen0", lambda a, b: a + b), "seen")
        sums = scratch.stored(joined.select("_key", "_block", seen.alias("seen"), (F.col("sum_before") + F.coalesce("sum0", F.lit(0.0))).alias("sum_before")), "sums")
        reach *= 2
    later = sums.select("_key", (F.col("_block") + 1).alias("_block"), "seen", "sum_before")
    first = sums.where("_block = 0").select("_key", "_block", F.transform("seen", lambda _: F.lit(0).cast("long")).alias("seen"), F.lit(0.0).alias("sum_before"))
    return later.unionByName(first)
