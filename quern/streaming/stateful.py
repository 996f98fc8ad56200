"""Streams whose state ends: keys expire by event time, and what an expired key was waiting for is told.

State is held by transformWithState in the RocksDB store, so it may be larger than memory. Every key has a timer; when the
watermark passes it, the key's state is removed. A stream that is stopped and started again goes on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Blocks of a page that one entry of its state tells apart.
WORD_BITS = 4096
#: Distinct blocks of a page that are gathered before they are stored.
BLOCKS_AT_ONCE = 1 << 16


def with_rocks(spark: SparkSession) -> None:
    """transformWithState needs this store; queries that run already keep theirs."""
    spark.conf.set(STORE, ROCKS)


class _Expiring(StatefulProcessor):
    """A processor with one timer a key, whose time is its state `until`."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until long")

    def close(self) -> None:
        pass


class Completion(StatefulProcessor):
    """A page's blocks are bits of words, and their number is kept beside them: each call of the state store waits for an answer,
    so a page costs a few calls a micro-batch, whatever the number of its blocks."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "word long", "bits binary")
        # of each page that is remembered: whether it was told, its distinct blocks until then, and until when it is remembered
        self.done = handle.getValueState("done", "done boolean, n long, until long")

    def add(self, blocks: set[int], new: bool) -> int:
        """Stores the blocks; how many of them were not there yet. new: nothing is stored of the page."""
        words: dict[int, int] = {}
        for block in blocks:
            words[block // WORD_BITS] = words.get(block // WORD_BITS, 0) | 1 << block % WORD_BITS
        added = 0
        for word, bits in words.items():
            old = None if new else self.blocks.getValue((word,))
            known = 0 if old is None else int.from_bytes(old[0], "little")
            if bits & ~known:
                added += (bits & ~known).bit_count()
                both = known | bits
                self.blocks.updateValue((word,), (both.to_bytes(-(-both.bit_length() // 8), "little"),))
        return added

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.done.get()
        done, n, until = known or (False, 0, None)
        expected, latest, blocks, stored = 0, 0, set(), known is not None
        for row in rows:
            expected, latest = max(expected, row.expected), max(latest, row.at_ms)
            if not done:
                blocks.add(row.block)
                if len(blocks) >= BLOCKS_AT_ONCE:
                    n, blocks, stored = n + self.add(blocks, not stored), set(), True
        if not done and not stored and len(blocks) >= expected:
            n, told = len(blocks), True  # complete at once: its blocks need not be stored
        else:
            n += self.add(blocks, not stored) if blocks else 0
            told = not done and n >= expected
            if told:
                self.blocks.clear()
        if until is None:
            self.handle.registerTimer(latest + self.keep_ms)
        # the timer stays where it is; when it ends, it moves on to the time that is told here
        self.done.update((done or told, n, max(latest + self.keep_ms, until or 0)))
        if told:
            yield Row(page=key[0], blocks=n, complete=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        done, n, until = self.done.get()
        if until > expiredTimerInfo.getExpiryTimeInMs() and until >= timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(until)
            return
        if not done:
            self.blocks.clear()
        self.done.clear()
        if not done:
            yield Row(page=key[0], blocks=n, complete=False)


def _timed(stream: DataFrame, ts: str, late: str) -> DataFrame:
    return stream.withWatermark(ts, late).withColumn("at_ms", F.unix_millis(F.col(ts)))


def page_completions(stream: DataFrame, ts: str, late: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """(page, blocks, complete) once for each page of a stream (page string, block long, expected long, ts): true as soon as as many
    distinct blocks as expected have arrived, false when nothing came for keep_ms before that. Blocks of a finished page are
    ignored while it is remembered. Rows later than the watermark are dropped."""
    with_rocks(stream.sparkSession)
    rows = _timed(stream, ts, late).select("page", "block", "expected", ts, "at_ms")
    return rows.groupBy("page").transformWithState(Completion(keep_ms), "page string, blocks long, complete boolean", "Append", "EventTime")


class Skip(_Expiring):
    """Lets the first row of a key pass and holds back what follows within `keep_ms` of it, after which a row passes anew."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["at_ms", "event_id"])
        passed, until = [], self.until.get()[0] if self.until.exists() else None
        before = until
        for at, name in zip(frame["at_ms"].astype(int), frame["event_id"], strict=True):
            if until is None or at >= until:
                until = int(at) + self.keep_ms
                passed.append((key[0], name))
        if passed:
            # one timer a call: each call of the state store waits for an answer
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(until)
            self.until.update((until,))
            yield pd.DataFrame(passed, columns=["key", "event_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.until.clear()
        yield pd.DataFrame({"key": pd.Series(dtype="int64"), "event_id": pd.Series(dtype="int64")})


def skip_list(stream: DataFrame, key: str, ts: str, event_id: str, late: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """(key, event_id) of the rows that pass: a key's first, and then each that is at least keep_ms after the last that passed. Rows of
    a micro-batch are taken in order of time and id; across batches they must arrive in order, late ones are dropped."""
    with_rocks(stream.sparkSession)
    rows = _timed(stream, ts, late).select(F.col(key).alias("key"), F.col(event_id).alias("event_id"), ts, "at_ms")
    return rows.groupBy("key").transformWithStateInPandas(Skip(keep_ms), "key long, event_id long", "Append", "EventTime")
