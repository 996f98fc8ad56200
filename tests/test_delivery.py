"""Streams whose state ends, and delivery with outcomes."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from quern.operators import state
from quern.streaming import delivery, stateful

PAGES = "page string, block long, expected long, ts timestamp"


def appended(spark, path, rows, schema):
    """One more file, later than those before."""
    time.sleep(0.05)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def streamed(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def run(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def held(spark, checkpoint, variable):
    return spark.read.format("statestore").option("stateVarName", variable).load(str(checkpoint)).count()


def test_pages_complete_or_expire_and_leave_no_state(spark, tmp_path):
    src, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    appended(spark, src, [("a", 1, 2, at(0)), ("b", 1, 3, at(0)), ("c", 1, 1, at(1))], PAGES)
    appended(spark, src, [("a", 1, 2, at(2)), ("a", 2, 2, at(3)), ("b", 2, 3, at(4))], PAGES)
    completed = lambda: stateful.page_completions(streamed(spark, src, PAGES), "ts", "10 minutes", keep_ms=3_600_000)
    run(completed(), out, cp)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(str(out)).collect())
    assert read() == [("a", 2, True), ("c", 1, True)]
    # a restart: a finished page is not told again, and b's last block is still missing when its time is over
    appended(spark, src, [("a", 2, 2, at(20)), ("c", 5, 1, at(20))], PAGES)
    for k in range(3):
        appended(spark, src, [("later", 1, 1, at(10_000 + k))], PAGES)
    run(completed(), out, cp)
    assert read() == [("a", 2, True), ("b", 2, False), ("c", 1, True), ("later", 1, True)]
    assert held(spark, cp, "blocks") == 0
    assert held(spark, cp, "done") == 1  # of the page that is still young


def test_skip_list_equals_a_plain_loop(spark, tmp_path):
    schema = "user long, event_id long, ts timestamp"
    rows = [(k % 3, k, at(17 * k)) for k in range(120)]
    for first in range(0, 120, 40):
        appended(spark, tmp_path / "in", rows[first : first + 40], schema)
    run(stateful.skip_list(streamed(spark, tmp_path / "in", schema), "user", "ts", "event_id", keep_ms=150 * 60_000), tmp_path / "out", tmp_path / "cp")
    wanted, until = set(), {}
    for user, name, ts in rows:
        if user not in until or ts >= until[user]:
            wanted.add((user, name))
            until[user] = ts + dt.timedelta(minutes=150)
    assert {(r.key, r.event_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == wanted
    assert held(spark, tmp_path / "cp", "until") <= 3


def sender(folder, fails=(), once=()):
    """A receiver that keeps every call as a file; some rows always fail, some in their first attempt."""

    def send(name, message):
        calls = [x for x in os.listdir(folder) if x.startswith(f"{name}-")]
        open(f"{folder}/{name}-{len(calls)}", "w").write(message)
        if name in fails or (name in once and not calls):
            raise ConnectionError(f"no answer for {name}")

    return send


MESSAGES = "id string, message string, ts timestamp"


@pytest.fixture
def mail(tmp_path):
    (tmp_path / "calls").mkdir()
    return tmp_path


def calls(mail):
    out = {}
    for x in os.listdir(mail / "calls"):
        out[x.split("-")[0]] = out.get(x.split("-")[0], 0) + 1
    return out


def test_outcomes_and_watermark(spark, mail):
    rows = [(f"m{k}", f"text {k}", at(k)) for k in range(10)] + [(None, "no id", at(3))]
    appended(spark, mail / "in", rows, MESSAGES)
    send = sender(str(mail / "calls"), fails=("m7",), once=("m2",))
    go = lambda s=send: delivery.deliver(streamed(spark, mail / "in", MESSAGES), str(mail / "out"), str(mail / "cp"), s, pause_s=0.0, pace_s=0.0)
    go()
    found = {r.id: (r.ok, r.attempts, r.error) for r in delivery.outcomes(spark, str(mail / "out")).collect()}
    assert found == {f"m{k}": (True, 1, None) for k in range(10)} | {"m2": (True, 2, None), "m7": (False, 3, "ConnectionError: no answer for m7")}
    assert calls(mail) == {f"m{k}": 1 for k in range(10)} | {"m2": 2, "m7": 3}
    assert state.advance(delivery.outcomes(spark, str(mail / "out")), "ts", "ok").first().watermark == at(7) - dt.timedelta(microseconds=1)
    go()  # nothing new
    assert sum(calls(mail).values()) == 13


def test_a_repeated_batch_sends_each_row_once(spark, mail):
    """A task is lost after some rows of its batch; the batch runs again."""
    appended(spark, mail / "in", [(f"m{k}", "", at(k)) for k in range(6)], MESSAGES)
    folder, broken = str(mail / "calls"), str(mail / "broken")
    open(broken, "w").close()
    plain = sender(folder)

    def send(name, message):
        if name == "m4" and os.path.exists(broken):
            raise SystemExit("the worker is lost")
        plain(name, message)

    go = lambda: delivery.deliver(streamed(spark, mail / "in", MESSAGES), str(mail / "out"), str(mail / "cp"), send, pause_s=0.0, pace_s=0.0)
    with pytest.raises(Exception):  # noqa: B017, PT011
        go()
    assert delivery.outcomes(spark, str(mail / "out")).count() == 0  # not committed
    assert sum(calls(mail).values()) == 4
    os.remove(broken)
    go()
    assert calls(mail) == {f"m{k}": 1 for k in range(6)}
    assert delivery.outcomes(spark, str(mail / "out")).where("ok").count() == 6


def test_senders_share_rows_and_know_their_own_logs(spark, mail):
    """Rows of one file are handed over by several tasks, and a batch that is repeated reads no sender's log but its own."""
    appended(spark, mail / "in", [(f"m{k}", "", at(k)) for k in range(40)], MESSAGES)
    folder, broken = str(mail / "calls"), str(mail / "broken")
    open(broken, "w").close()
    plain = sender(folder)

    def send(name, message):
        if name == "m17" and os.path.exists(broken):
            raise SystemExit("the worker is lost")
        plain(name, message)

    go = lambda n: delivery.deliver(streamed(spark, mail / "in", MESSAGES), str(mail / "out"), str(mail / "cp"), send, senders=n, pause_s=0.0, pace_s=0.0)
    with pytest.raises(Exception):  # noqa: B017, PT011
        go(4)
    os.remove(broken)
    go(3)  # dealt otherwise than before
    assert calls(mail) == {f"m{k}": 1 for k in range(40)}
    found = delivery.outcomes(spark, str(mail / "out"))
    assert found.where("ok").count() == found.select("id").distinct().count() == 40
    logs = {x.split("-")[0] for _, _, names in os.walk(mail / "out") for x in names if "-of-000003-" in x}
    assert len(logs) > 1


def test_pauses_double():
    slept = []

    def send(name, message):
        raise TimeoutError

    assert delivery.attempted(send, "a", "b", 3, 3.0, slept.append) == (False, 3, "TimeoutError: ")
    assert slept == [3.0, 6.0]
    assert F is not None
