"""Key rotation and configuration for rate-limited services."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.ratelimit import Bucket, Limits

DEFAULTS = {"api_keys": [], "labels": [], "model": "default"}


def config(spark: SparkSession, path: str) -> dict:
    """A JSON object with defaults for what is missing or unreadable; a single key becomes a list of one."""
    try:
        text = spark.read.text(path, wholetext=True).first()
        loaded = json.loads(text.value) if text else {}
    except Exception:
        loaded = {}
    out = DEFAULTS | (loaded if isinstance(loaded, dict) else {})
    for name in ("api_keys", "labels"):
        if isinstance(out[name], str):
            out[name] = [out[name]]
    return out


@dataclass
class Rotation:
    """Round robin over keys that may be used now."""

    labels: Sequence[str]
    limits: Limits = Limits()
    buckets: dict[str, Bucket] = field(default_factory=dict)
    at: int = 0

    def next(self, now: float) -> str | None:
        """The next usable label, charged for one success; None if every key refuses."""
        for _ in range(len(self.labels)):
            label = self.labels[self.at % len(self.labels)]
            self.at += 1
            if self.buckets.setdefault(label, Bucket(self.limits)).ask(now) == "allowed":
                return label
        return None


def assign(requests: DataFrame, queue: str, order: Sequence[str], seconds: str, labels: Sequence[str], limits: Limits = Limits()) -> DataFrame:
    """Adds label to requests (null where no key was usable). Each queue, a service with its own set of keys, takes its
    requests one after the other in the given order; rows stream through with the queue's buckets as the only state."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema) + ", label string"

    def run(frames: Iterator) -> Iterator:
        last, rotation = None, Rotation(list(labels), limits)
        for frame in frames:
            out = []
            for name, now in zip(frame[queue], frame[seconds], strict=True):
                if name != last:
                    last, rotation = name, Rotation(list(labels), limits)
                out.append(rotation.next(float(now)))
            yield frame.assign(label=out)

    return requests.repartition(queue).sortWithinPartitions(queue, *order).mapInPandas(run, schema)


def no_key_available(error: str) -> F.col:
    """Whether an error column says that keys are exhausted."""
    low = F.lower(F.coalesce(F.col(error), F.lit("")))
    return (low == "no_key_available") | F.contains(low, F.lit("no api key available")) | F.contains(low, F.lit("no key available"))


def still_valid(cache: DataFrame, checked_at: str, now, days: int = 1) -> DataFrame:
    """Cached validations (by key hash and model) that need no new probe."""
    return cache.where(F.col(checked_at) > now - F.make_dt_interval(F.lit(days)))
