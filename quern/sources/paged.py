"""A paged service as a Spark data source: numbered pages of JSON items, read in batch or as a stream whose offset is a page.

Pages are recorded files `page_<n>.json`, from 1, below a folder that all machines share (or what a cache of them holds): arrays
of objects. A page that has once been read is kept under its version, the digest of its bytes, and is not asked for again while the
listing shows the same one.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from quern.streaming.delivery import _store

PAGE = re.compile(r"page_(\d+)\.json$")


class Page(InputPartition):
    def __init__(self, number: int, path: str):
        super().__init__(number)
        self.number, self.path = number, path


def pages(folder: str) -> list[Page]:
    """The recorded pages in order, up to the first number that is missing: later ones may still be on their way."""
    from pyarrow import fs

    store, at = _store(folder)
    if store.get_file_info(at).type == fs.FileType.NotFound:
        return []
    found = {int(m[1]): i.path for i in store.get_file_info(fs.FileSelector(at)) if (m := PAGE.search(posixpath.basename(i.path)))}
    out = []
    while len(out) + 1 in found:
        out.append(Page(len(out) + 1, posixpath.join(folder, posixpath.basename(found[len(out) + 1]))))
    return out


def items(page: Page, cache: str | None) -> list[dict]:
    """The items of a page. With a cache folder, the parsed page is kept by number and version."""
    store, at = _store(page.path)
    with store.open_input_stream(at) as f:
        raw = f.read()
    if cache is None:
        return json.loads(raw or b"[]")
    from pyarrow import fs

    kept, folder = _store(cache)
    name = posixpath.join(folder, f"page_{page.number}-{hashlib.sha256(raw).hexdigest()[:16]}.json")
    if kept.get_file_info(name).type == fs.FileType.NotFound:
        kept.create_dir(folder, recursive=True)
        with kept.open_output_stream(name + ".tmp") as f:
            f.write(json.dumps(json.loads(raw or b"[]")).encode())
        kept.move(name + ".tmp", name)
    with kept.open_input_stream(name) as f:
        return json.loads(f.read())


class _Reading:
    """What both readers share: a page is a partition, a row has the schema's fields in order, null where an item lacks one."""

    def __init__(self, schema: StructType, options: dict):
        self.names, self.folder, self.cache = schema.names, options["path"], options.get("cache")

    def read(self, partition: Page | None) -> Iterator[tuple]:
        for item in items(partition, self.cache) if partition else ():  # None where there are no pages
            yield tuple(item.get(n) for n in self.names)


class PagedReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Page]:
        return pages(self.folder)


class PagedStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": len(pages(self.folder))}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return [p for p in pages(self.folder) if start["page"] < p.number <= end["page"]]

    def commit(self, end: dict) -> None:
        """Recorded pages stay where they are."""


class PagedSource(DataSource):
    """spark.read.format("paged").schema(...).option("path", ...).load(), and readStream; register it with register(spark)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(schema, self.options)


def register(spark) -> None:
    spark.dataSource.register(PagedSource)
