"""Files with names of their own, one for each row: page texts, images, listings, attachments, exports."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern import scratch

#: Files whose bytes a task holds before it writes them.
BUFFER = 80
#: Tasks for each core that rows are dealt to: a table may lie in a few row groups, and a file costs more than its row's way.
TASKS_PER_CORE = 4


def write_files(df: DataFrame, path: str, name: Column, content: Column) -> DataFrame:
    """Writes `content` (text or bytes) of each row to the file `name` (a relative path) below `path`, and returns the stored
    manifest (name, bytes).

    A file is written under a name of its attempt and then moved, so a reader meets it whole or not at all, and a task that is
    run again only replaces it. Tasks write for themselves, BUFFER rows at a time; path is a folder that all machines share.
    Names should be unique: of equal ones the last move stays. Rows with a null name are left out, null content is an empty file."""
    root = path if urlparse(path).scheme else f"file://{path}"
    scratch.folder(df.sparkSession, root)
    rows = df.select(name.alias("name"), F.coalesce(content.cast("binary"), F.lit(b"")).alias("content")).where("name is not null")
    rows = rows.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, "name")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for frame in frames:
            for first in range(0, len(frame), BUFFER):
                part = frame.iloc[first : first + BUFFER]
                for name, content in zip(part["name"], part["content"], strict=True):
                    target = posixpath.join(base, name)
                    folder = posixpath.dirname(target)
                    if folder not in made:
                        store.create_dir(folder, recursive=True)
                        made.add(folder)
                    attempt = posixpath.join(folder, f"_{uuid.uuid4().hex}.tmp")
                    with store.open_output_stream(attempt) as out:
                        out.write(content)
                    store.move(attempt, target)
                yield pd.DataFrame({"name": part["name"], "bytes": part["content"].map(len)})

    return scratch.stored(rows.mapInPandas(run, "name string, bytes long"), "manifest")


def write_json_array(df: DataFrame, path: str, name: Column) -> DataFrame:
    """Rows as JSON arrays, one file for each value of `name`; a file's rows should be few, as one row holds them."""
    rows = df.withColumn("_name", name).groupBy("_name").agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("_json"))
    return write_files(rows, path, F.col("_name"), F.col("_json"))
