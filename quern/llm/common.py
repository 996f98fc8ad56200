"""Shared helpers: tables, scratch storage, membership sifting and batched text access."""

from __future__ import annotations

import ctypes
import functools
import os
import zlib
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.scratch import ROW_GROUP_BYTES, clear, path as scratch_path, remove, root as scratch_root, stored  # noqa: F401  (the operators' scratch)

#: Rows of an Arrow batch that carries whole texts; bounds a Python worker's memory on tables of long documents.
TEXT_ROWS_PER_BATCH = 512
#: Bytes of an Arrow batch beyond which no further row is added to it.
TEXT_BYTES_PER_BATCH = 8 << 20
#: Upper-case ASCII letters and their lower-case forms: the only case folding the contracts ask for.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys with at least one in so many rows are joined by broadcast: so many at most.
HEAVY_SHARE = 1000
#: Words of 64 bits in the largest membership filter that is broadcast: 2**20 words are about 40 MB as rows.
MAX_FILTER_WORDS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_text_batches(spark: SparkSession) -> None:
    """Lowers (never raises) the session's Arrow batches to TEXT_ROWS_PER_BATCH rows and TEXT_BYTES_PER_BATCH bytes, as texts
    may be very long. The settings are the session's, as Spark has none for a single operator."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= TEXT_ROWS_PER_BATCH:
        spark.conf.set(key, str(TEXT_ROWS_PER_BATCH))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, str(1 << 30)) == str(1 << 30):  # a value that was set is left as it is
        spark.conf.set(key, str(TEXT_BYTES_PER_BATCH))


def give_back() -> None:
    """Returns to the system what Arrow's pool and the C library keep of freed memory. They keep it for good, and a worker outlives
    its task: the executor's other tasks would have to do without it."""
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
        trim(0)


def gives_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a task's function of batches, which gives memory back when its batches are over."""

    @functools.wraps(run)
    def tidy(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidy


def text_flags(judge: Callable[[], Callable[[list[str | None]], list[bool]]], text: Column) -> Column:
    """A boolean for each text. judge() makes a worker's function of a batch's texts. Only the texts go to Python; the rows
    stay in the JVM."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = judge()
        for batch in batches:
            yield pa.array(found(batch.to_pylist()), pa.bool_())

    tidy = gives_back(run)
    tidy.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(tidy, "boolean")(text)


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """A worker's model, made once. A worker holds one at a time: the next stage's takes the place of the last one's."""
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


_held: dict[Hashable, Any] = {}


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal id modulo modulus; null ids count as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def id_remainder_local(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def filter_words(expected: int) -> int:
    """64-bit words of a membership filter: about 8 bits for each expected key, between 2**10 and MAX_FILTER_WORDS."""
    words = 1 << 10
    while words * 8 < expected and words < MAX_FILTER_WORDS:
        words *= 2
    return words


def membership_filter(hashes: DataFrame, words: int) -> DataFrame:
    """hashes: one long column h. Rows (w, bits), at most `words` of them: bit h mod 64 of word (h div 64) mod words."""
    h = F.col("h")
    return hashes.groupBy(F.pmod(F.shiftright(h, 6), F.lit(words)).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))


def maybe_member(df: DataFrame, h: Column, filt: DataFrame, words: int, out: str) -> DataFrame:
    """Adds boolean `out`: false only if h is surely absent. The filter is broadcast; `words` bounds its rows."""
    w, bits = f"{out}_w", f"{out}_bits"
    f = F.broadcast(filt.select(F.col("w").alias(w), F.col("bits").alias(bits)))
    hit = F.coalesce(F.expr(f"shiftright({bits}, cast({out}_h & 63 as int)) & 1L") == 1, F.lit(False))
    df = df.withColumn(f"{out}_h", h)
    df = df.withColumn(f"{out}_k", F.pmod(F.shiftright(F.col(f"{out}_h"), 6), F.lit(words)))
    return df.join(f, F.col(f"{out}_k") == F.col(w), "left").withColumn(out, hit).drop(w, bits, f"{out}_h", f"{out}_k")


def without_rows(docs: DataFrame, dropped: DataFrame, expected: int, on: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs without the rows whose `on` columns are in `dropped` (about `expected` rows). Only rows that may be dropped,
    by a broadcast filter of bounded size, meet the exact anti join, so the texts of the rest are never shuffled. Rows
    with a null among `on` stay."""
    words = filter_words(expected)
    keys = dropped.select(*on).na.drop()
    whole = " and ".join(f"{c} is not null" for c in on)
    flagged = maybe_member(docs, F.xxhash64(*on), membership_filter(keys.select(F.xxhash64(*on).alias("h")), words), words, "_quern_maybe")
    sure = flagged.where(f"not ({whole} and _quern_maybe)").drop("_quern_maybe")
    rest = flagged.where(f"{whole} and _quern_maybe").drop("_quern_maybe").join(keys.distinct(), list(on), "left_anti")
    return sure.select(docs.columns).unionByName(rest.select(docs.columns))


def counted(rows: DataFrame, on: str) -> DataFrame:
    return stored(rows.groupBy(on).agg(F.count(F.lit(1)).alias("_quern_n")), "counts")


def joined(rows: DataFrame, other: DataFrame, on: str, counts: DataFrame | None = None) -> DataFrame:
    """rows joined with other, whose `on` is unique. Keys behind which many rows stand are joined by broadcast. counts are
    the rows' own (counted), where they are at hand."""
    counts = counted(rows, on) if counts is None else counts
    least = max(2, -(-(counts.agg(F.sum("_quern_n")).first()[0] or 0) // HEAVY_SHARE))
    heavy = stored(counts.where(F.col("_quern_n") >= least).select(on), "heavy")
    hot = rows.join(F.broadcast(other.join(F.broadcast(heavy), on, "left_semi")), on)
    cold = rows.join(F.broadcast(heavy), on, "left_anti").join(other, on)
    return hot.unionByName(cold)


def strings(column) -> list[str]:
    """An Arrow or pandas string column as Python strings; nulls become empty."""
    values = column.to_pylist() if hasattr(column, "to_pylist") else list(column)
    return ["" if v is None else v for v in values]


def batches_of(rows: Iterator, size: int) -> Iterator[list]:
    part: list = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield part
            part = []
    if part:
        yield part


def env_threads_off() -> None:
    """A task is one core: the tokenizers library must not start a thread pool of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
