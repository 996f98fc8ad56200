"""Strict redo, notification and the runner's endless retries."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.__main__ import main
from quern.operators import notify, redo
from quern.operators.state import StateTable
from quern.plans import stages

EMPTY = "g string, k long, out string"


def test_only_open_groups_are_computed_again(spark, tmp_path):
    path, empty = str(tmp_path / "out"), spark.createDataFrame([], EMPTY)
    expected = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 4), (None, 5)], "g string, k long")
    asked = []

    def compute(bad):
        def run(rows):
            asked.append(sorted(r.k for r in rows.collect()))
            return rows.withColumn("out", F.when(~F.col("k").isin(bad), F.concat(F.lit("r"), F.lit(str(len(asked))))))

        return run

    go = lambda bad: redo.redo(expected, path, compute(bad), "g", "k", lambda d: F.col("out").isNotNull(), empty)
    assert go([4]) == 4

    def broken(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        redo.redo(expected, path, broken, "g", "k", lambda d: F.col("out").isNotNull(), empty)
    assert go([99]) == 2
    assert go([99]) == 0
    assert asked == [[1, 2, 3, 4], [3, 4]]
    assert sorted((r.g, r.k, r.out) for r in redo.outputs(spark, path, empty).collect()) == [("a", 1, "r1"), ("a", 2, "r1"), ("b", 3, "r2"), ("b", 4, "r2")]


def test_what_is_pending(spark):
    jobs = spark.createDataFrame([(k, dt.datetime(2024, 1, k)) for k in range(1, 6)], "id int, ts timestamp")
    ids = lambda *a, **b: [r.id for r in notify.pending(jobs, "ts", *a, **b).collect()]
    mark = F.lit("2024-01-03").cast("timestamp")
    assert ids(mark) == [4, 5]
    assert ids(F.lit(None).cast("timestamp")) == ids(mark, force=True) == [1, 2, 3, 4, 5]
    assert ids(mark, since=F.lit("2024-01-02").cast("timestamp")) == [2, 3, 4, 5]


def test_command_line_notifies_once(spark, tmp_path, capfd):
    state = str(tmp_path / "state")
    jobs = spark.createDataFrame([(f"j{k}", 0.5, dt.datetime(2024, 1, k)) for k in range(1, 4)], "job_id string, similarity double, shortlisted_at timestamp")
    StateTable(spark, state).write(jobs)

    def run(*more):
        main(["notify", state, str(tmp_path / "sent"), "--pace", "0", *more], spark)
        return [x for x in capfd.readouterr().out.splitlines() if "delivered" in x]

    assert run("--dry-run") == ["3 delivered, 0 failed"]
    assert run() == ["3 delivered, 0 failed"]
    assert run() == ["0 delivered, 0 failed"]
    assert run("--since", "2024-01-02") == ["2 delivered, 0 failed"]
    assert run("--force") == ["3 delivered, 0 failed"]


def test_a_stage_may_be_tried_without_end(spark, tmp_path):
    calls, slept = [], []

    def run(_):
        calls.append(1)
        if len(calls) < 9:
            raise OSError

    assert stages.run(spark, [stages.Stage("a", run)], StateTable(spark, str(tmp_path / "s")), attempts=None, sleep=slept.append) == ["a"]
    assert slept == [10.0, 20.0, 40.0, 80.0, 160.0, 300.0, 300.0, 300.0]
