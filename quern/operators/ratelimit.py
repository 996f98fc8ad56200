"""Rate limits: token bucket, daily quota and cool-down for each key, over ordered requests."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    per_day: int = 20
    per_minute: float = 15.0
    burst: float = 5.0
    cooldown_s: float = 60.0


@dataclass
class Bucket:
    """A key's state. Times are seconds since the epoch; days are UTC."""

    limits: Limits
    tokens: float = -1.0
    refilled: float = 0.0
    day: int = -1
    used: int = 0
    blocked_until: float = 0.0

    def ask(self, now: float, succeeds: bool = True, throttled: bool = False) -> str:
        """allowed, or the rule that refuses: cooldown, quota or tokens. Only an allowed success is charged."""
        if self.tokens < 0:
            self.tokens, self.refilled = self.limits.burst, now
        if self.day != (today := int(now // 86400)):
            self.day, self.used = today, 0
        if now < self.blocked_until:
            return "cooldown"
        if self.used >= self.limits.per_day:
            return "quota"
        self.tokens = min(self.limits.burst, self.tokens + (now - self.refilled) * self.limits.per_minute / 60)
        self.refilled = now
        if self.tokens < 1:
            return "tokens"
        if throttled:
            self.blocked_until = now + self.limits.cooldown_s
        elif succeeds:
            self.tokens -= 1
            self.used += 1
        return "allowed"


def token_bucket(requests: DataFrame, key: str, ts: str, tie: str, limits: Limits = Limits(), ok: str | None = None, throttled: str | None = None) -> DataFrame:
    """Adds decision to each request. ok and throttled name boolean columns with an allowed request's outcome.

    The fold streams over rows sorted by (key, ts, tie) with one bucket in memory at a time."""
    rows = requests.withColumn("_s", F.unix_micros(F.col(ts).cast("timestamp")) / 1e6)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema) + ", decision string"

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, bucket = None, Bucket(limits)
        for frame in frames:
            good = frame[ok] if ok else [True] * len(frame)
            slow = frame[throttled] if throttled else [False] * len(frame)
            out = []
            for k, now, succeeds, limited in zip(frame[key], frame["_s"], good, slow, strict=True):
                if k != last:
                    last, bucket = k, Bucket(limits)
                out.append(bucket.ask(now, bool(succeeds), bool(limited)))
            yield frame.drop(columns="_s").assign(decision=out)

    return rows.repartition(key).sortWithinPartitions(key, ts, tie).mapInPandas(fold, schema)
