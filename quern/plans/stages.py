"""A stage runner with a run-state table: stages that are done are skipped, failures are retried with back-off."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quern.operators.state import StateTable

FIRST_PAUSE_S, LONGEST_PAUSE_S = 10.0, 300.0


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[SparkSession], None]
    needs: tuple[str, ...] = ()


def ordered(stages: Sequence[Stage]) -> list[Stage]:
    """Stages after what they need, otherwise in the given order."""
    out: list[Stage] = []
    left = list(stages)
    while left:
        ready = [s for s in left if set(s.needs) <= {x.name for x in out}]
        if not ready:
            raise ValueError(f"stages need each other or something unknown: {[s.name for s in left]}")
        out.append(ready[0])
        left.remove(ready[0])
    return out


def run(spark: SparkSession, stages: Sequence[Stage], state: StateTable, attempts: int | None = 3, force: bool = False, sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """Runs what is not done (all with force) and returns the names that ran. A stage that fails all attempts raises; without a
    number of attempts (None) a stage is tried until it succeeds."""
    known = state.read()
    done = set() if force or known is None else {r.stage for r in known.where("status = 'done'").select("stage").collect()}
    ran = []
    for stage in ordered(stages):
        if stage.name in done:
            continue
        for k in itertools.count():
            try:
                stage.run(spark)
                break
            except Exception:
                if k + 1 == attempts:
                    mark(spark, state, stage.name, "failed")
                    raise
                sleep(min(FIRST_PAUSE_S * 2 ** min(k, 30), LONGEST_PAUSE_S))
        mark(spark, state, stage.name, "done")
        ran.append(stage.name)
    return ran


def mark(spark: SparkSession, state: StateTable, stage: str, status: str) -> None:
    row = spark.range(1).select(F.lit(stage).alias("stage"), F.lit(status).alias("status"), F.current_timestamp().alias("at"))
    state.upsert(row, ["stage"], [F.desc("at")])
