"""Notification of what is new since the last time: selection, delivery with outcomes, and the next watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.operators import state
from quern.streaming.delivery import ATTEMPTS, FIRST_PAUSE_S, PACE_S, Send, attempted


def pending(jobs: DataFrame, ts: str, watermark: Column, since: Column | None = None, force: bool = False) -> DataFrame:
    """Rows to deliver, oldest first: those after the watermark (all of a null one), from `since` on where that is given
    instead, all with `force`."""
    if force:
        return jobs.orderBy(ts)
    if since is not None:
        return jobs.where(F.col(ts) >= since).orderBy(ts)
    return state.newer_than(jobs, ts, watermark)


def delivered(rows: DataFrame, send: Send, dry_run: bool = False, attempts: int = ATTEMPTS, pause_s: float = FIRST_PAUSE_S, pace_s: float = PACE_S) -> DataFrame:
    """(id, ts, ok, attempts, error) of rows (id, message, ts), stored, so nothing is handed over again when the outcomes are read.

    Attempts that fail are repeated after pauses that double, and a task waits pace_s after each row. A dry run hands nothing over
    and counts every row as delivered. As a task that is lost starts again, receivers know rows by their ids; a stream
    (`streaming.delivery`) keeps a log of each row."""
    import time

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, message in zip(frame["id"], frame["message"], strict=True):
                out.append((True, 0, None) if dry_run else attempted(send, name, message or "", attempts, pause_s))
                if not dry_run:
                    time.sleep(pace_s)
            yield pd.concat([frame[["id", "ts"]].reset_index(drop=True), pd.DataFrame(out, columns=["ok", "attempts", "error"])], axis=1)

    return scratch.stored(rows.select("id", "message", "ts").mapInPandas(run, "id string, ts timestamp, ok boolean, attempts int, error string"), "outcomes")


def next_watermark(outcomes: DataFrame, dry_run: bool = False) -> DataFrame:
    """One row (watermark): before the first failure, else the last time; null where nothing moves it on (a dry run, no rows)."""
    return state.advance(outcomes.where(F.lit(not dry_run)), "ts", "ok")
