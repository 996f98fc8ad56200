"""Delivery as a streaming sink: every row is handed over once, with its outcome.

A task notes each row's outcome in a log of its attempt, line by line, before it takes the next row. A batch that is repeated,
because a task or the driver was lost, reads the logs of its earlier attempts and hands over only what they lack. When
all tasks have ended, the driver commits the batch: it writes the list of the logs that count, and only those are read as
outcomes. Rows are dealt to senders by their ids, so a repeated task finds its rows in the logs of its own sender and reads no
others. What cannot be told apart is a row whose hand-over ended just before its line was written; the receiver has to know
it by its id, as in any delivery.
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

OUTCOMES = "batch long, id string, ts timestamp, ok boolean, attempts int, error string"
#: Fixed values of the service: attempts, the first pause before another, and the pause between two messages, in seconds.
ATTEMPTS, FIRST_PAUSE_S, PACE_S = 3, 3.0, 1.5

Send = Callable[[str, str], None]


@dataclass
class Logged(WriterCommitMessage):
    log: str | None


def attempted(send: Send, name: str, message: str, attempts: int, pause_s: float, sleep: Callable[[float], None] = time.sleep) -> tuple[bool, int, str | None]:
    """(delivered, attempts made, last error); pauses double from one attempt to the next."""
    error = None
    for k in range(attempts):
        try:
            send(name, message)
            return True, k + 1, None
        except Exception as e:  # the receiver's errors are outcomes
            error = f"{type(e).__name__}: {e}"
        if k + 1 < attempts:
            sleep(pause_s * 2**k)
    return False, attempts, error


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _lines(path: str) -> list[dict]:
    """Whole lines of a log; one that was cut off by a loss does not count."""
    store, at = _store(path)
    with store.open_input_stream(at) as f:
        text = f.read().decode()
    return [json.loads(x) for x in text.split("\n")[:-1]]


def _listed(folder: str) -> list[str]:
    from pyarrow import fs

    store, at = _store(folder)
    if store.get_file_info(at).type == fs.FileType.NotFound:
        return []
    return sorted(posixpath.join(folder, posixpath.basename(i.path)) for i in store.get_file_info(fs.FileSelector(at)) if i.is_file)


class Writer(DataSourceStreamWriter):
    def __init__(self, folder: str, send: Send, attempts: int, pause_s: float, pace_s: float, senders: int):
        self.folder, self.send, self.attempts, self.pause_s, self.pace_s, self.senders = folder, send, attempts, pause_s, pace_s, senders

    def write(self, iterator: Iterator) -> Logged:
        from pyspark import TaskContext

        # the sink is told its batch when it commits; a task reads it off the rows' local property
        batch = TaskContext.get().getLocalProperty("streaming.sql.batchId")
        folder = posixpath.join(self.folder, f"batch-{int(batch):012d}")
        own, dealt = f"{TaskContext.get().partitionId():06d}-of-{self.senders:06d}-", f"-of-{self.senders:06d}-"
        # logs of another number of senders were dealt otherwise, so all of them are read
        logs = [x for x in _listed(folder) if (name := posixpath.basename(x)).startswith(own) or dealt not in name]
        known = {line["id"] for log in logs for line in _lines(log)}
        store, at = _store(folder)
        out, log = None, None
        for row in iterator:
            if row["id"] in known:
                continue
            if out is None:
                store.create_dir(at, recursive=True)
                log = f"{own}{uuid.uuid4().hex}.jsonl"
                out = store.open_output_stream(posixpath.join(at, log))
            ok, attempts, error = attempted(self.send, row["id"], row["message"], self.attempts, self.pause_s)
            line = {"batch": int(batch), "id": row["id"], "ts": row["ts"].isoformat() if row["ts"] else None, "ok": ok, "attempts": attempts, "error": error}
            out.write((json.dumps(line) + "\n").encode())
            out.flush()
            if self.pace_s:
                time.sleep(self.pace_s)
        if out is not None:
            out.close()
        return Logged(log)

    def commit(self, messages, batchId: int) -> None:
        """All logs of the batch's folder count, those of attempts that were lost included."""
        logs = [posixpath.basename(x) for x in _listed(posixpath.join(self.folder, f"batch-{batchId:012d}"))]
        store, at = _store(posixpath.join(self.folder, "committed"))
        store.create_dir(at, recursive=True)
        attempt = posixpath.join(at, f"_{uuid.uuid4().hex}.tmp")
        with store.open_output_stream(attempt) as f:
            f.write(json.dumps(logs).encode())
        store.move(attempt, posixpath.join(at, f"{batchId:012d}.json"))

    def abort(self, messages, batchId: int) -> None:
        """The logs stay, so that the repeated batch knows what was handed over."""


def sink(name: str, send: Send, attempts: int = ATTEMPTS, pause_s: float = FIRST_PAUSE_S, pace_s: float = PACE_S, senders: int = 1) -> type[DataSource]:
    """A data source of that name whose stream writer hands rows (id string, message string, ts timestamp) to `send`, which raises
    if it fails. Its option `path` is the folder of outcomes, which all machines share. Rows come in `senders` partitions by id."""

    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite: bool) -> Writer:
            return Writer(self.options["path"], send, attempts, pause_s, pace_s, senders)

    return Delivery


def deliver(stream: DataFrame, path: str, checkpoint: str, send: Send, senders: int = 1, **options: float) -> None:
    """Delivers what is new in the stream (id, message, ts) and returns. Rows without an id are left out.

    `senders` tasks share the rows by id and each keeps the pace for itself; one sender keeps it overall."""
    spark = stream.sparkSession
    name = f"delivery_{uuid.uuid4().hex}"
    spark.dataSource.register(sink(name, send, senders=senders, **options))
    rows = stream.where("id is not null").select("id", F.coalesce("message", F.lit("")).alias("message"), "ts").repartition(senders, "id")
    rows.writeStream.format(name).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The outcomes (OUTCOMES) of committed batches."""
    logs = []
    for commit in _listed(posixpath.join(path, "committed")):
        store, at = _store(commit)
        with store.open_input_stream(at) as f:
            batch = posixpath.splitext(posixpath.basename(commit))[0]
            logs += [posixpath.join(path, f"batch-{batch}", x) for x in json.loads(f.read())]
    return spark.read.schema(OUTCOMES).json(logs) if logs else spark.createDataFrame([], OUTCOMES)
