"""Token-ID output: one concatenated id array with Elias-Fano encoded document boundaries.

File format. A store is a Parquet folder of blocks. The documents are in ascending (doc_id, text) order; a shard is one
write task's range of them (numbered in order) and a block at most BLOCK_TOKENS ids of a shard, so that no reader needs more than a block in
memory (a single longer document is a block of its own). A block's row holds

* shard, block: its place; task, first_id, last_id, ascending: what its order is verified by; doc_ids: its documents' ids, delta coded (zigzag varints), a null flag kept apart;
* n_docs, n_tokens: counts; width: bytes of an id, 2 if the vocabulary fits, else 4; ids: the little-endian id array;
* low, low_bits, high, select: the Elias-Fano code of the documents' end offsets in that array.

An Elias-Fano code of n ascending values up to u keeps each value's low floor(log2(u/n)) bits in one packed array and
the rest as unary gaps in a bit vector of about 2n bits. `select` samples the position of every SELECT_EVERY-th one, so an
offset is found by a jump and a short scan: about 2 + log2(u/n) bits a document and no table of 64-bit offsets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm import common
from quern.llm.tokens import encoded, encoder

BLOCK_TOKENS = 1 << 20
SELECT_EVERY = 64
BLOCK_SCHEMA = "shard int, block int, task int, first_id long, last_id long, ascending boolean, doc_ids binary, nulls binary, n_docs int, n_tokens long, width int, ids binary, low binary, low_bits int, high binary, select binary"
ROW_SCHEMA = "shard int, block int, pos int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
TOKEN_SCHEMA = "shard int, block int, pos int, doc_id long, local_start long, n_tokens long, ids array<int>"


class EliasFano:
    """Ascending non-negative integers in near-minimal space, with select (the i-th value). The bits stay packed."""

    def __init__(self, low: bytes, low_bits: int, high: bytes, select: bytes, n: int):
        self.low, self.low_bits, self.n = low, low_bits, n
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.samples = np.frombuffer(select, dtype="<u4")

    @staticmethod
    def encode(values: np.ndarray) -> tuple[bytes, int, bytes, bytes]:
        """(low, low_bits, high, select) of ascending values."""
        n = len(values)
        if n == 0:
            return b"", 0, b"", b""
        values = values.astype(np.uint64)
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        lows = values & np.uint64((1 << low_bits) - 1)
        packed = ((lows[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        return np.packbits(packed.ravel(), bitorder="little").tobytes(), low_bits, np.packbits(high, bitorder="little").tobytes(), ones[::SELECT_EVERY].astype("<u4").tobytes()

    def lows(self, i: int, j: int) -> np.ndarray:
        """The low parts of values i to j - 1."""
        if not self.low_bits:
            return np.zeros(j - i, dtype=np.int64)
        first, last = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8)[first // 8 : (last + 7) // 8], bitorder="little")
        bits = bits[first % 8 : first % 8 + last - first].reshape(j - i, self.low_bits)
        return bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value: a jump to the sample before it, then a scan of the bytes that follow."""
        return int(self.range(i, i + 1)[0])

    def range(self, i: int, j: int) -> np.ndarray:
        """Values i to j - 1, from the bytes between the samples around them."""
        first = int(self.samples[i // SELECT_EVERY])
        after = -(-j // SELECT_EVERY)
        last = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first // 8 : last // 8 + 1], bitorder="little")) + first // 8 * 8
        skipped = int(np.searchsorted(ones, first)) + i % SELECT_EVERY
        return ((ones[skipped : skipped + j - i] - np.arange(i, j)) << self.low_bits) + self.lows(i, j)

    def spans(self) -> Iterator[tuple[int, int]]:
        """(start, end) of each document between the ends coded here, decoded SELECT_EVERY at a time."""
        at = 0
        for i in range(0, self.n, SELECT_EVERY):
            for end in self.range(i, min(self.n, i + SELECT_EVERY)).tolist():
                yield at, end
                at = end

    def all(self) -> np.ndarray:
        """Every value, in order."""
        return self.range(0, self.n) if self.n else np.zeros(0, dtype=np.int64)


def pack_ids(doc_ids: list[int | None]) -> tuple[bytes, bytes]:
    """Zigzag varints of the differences of the ids, and a bit for each null (which counts as its predecessor)."""
    out, last = bytearray(), 0
    for x in doc_ids:
        gap = (last if x is None else x) - last
        last += gap
        z = gap << 1 if gap >= 0 else (-gap << 1) - 1
        while z >= 128:
            out.append(z & 127 | 128)
            z >>= 7
        out.append(z)
    return bytes(out), np.packbits([x is None for x in doc_ids], bitorder="little").tobytes() if None in doc_ids else b""


def unpack_ids(packed: bytes, nulls: bytes, n: int) -> list[int | None]:
    out, last, z, shift = [], 0, 0, 0
    for b in packed:
        z |= (b & 127) << shift
        shift += 7
        if b < 128:
            last += z >> 1 if not z & 1 else -((z + 1) >> 1)
            out.append(last)
            z = shift = 0
    if nulls:
        is_null = np.unpackbits(np.frombuffer(nulls, dtype=np.uint8), bitorder="little")[:n]
        out = [None if b else x for x, b in zip(out, is_null, strict=True)]
    return out


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encodes every text of docs (doc_id, text; null counts as empty), appends end_id to each, and writes the store.

    A table whose partitions already are ascending ranges of ids, as corpora are mostly written, is encoded where it lies:
    its ids are looked at first, and the order of what was written is verified. Any other table is dealt out by ranges
    of doc_id. Rows of one id stay in one shard, ordered by text; null ids come first and are kept as nulls; extra columns are
    ignored. An empty table gives an empty store. One row for each input partition comes to the driver."""
    spark = docs.sparkSession
    common.small_text_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = _ascending_partitions(rows)
    if ranks is not None:
        rows.mapInArrow(_block_writer(tokenizer, end_id, ranks), BLOCK_SCHEMA).write.option("parquet.block.size", common.ROW_GROUP_BYTES).parquet(path)
        if _in_order(spark, path):
            return
        common.remove(spark, path)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ranged.mapInArrow(_block_writer(tokenizer, end_id, None), BLOCK_SCHEMA).write.option("parquet.block.size", common.ROW_GROUP_BYTES).parquet(path)


def _ascending_partitions(rows: DataFrame) -> dict[int, int] | None:
    """partition -> its place, if each partition's ids strictly ascend and no two partitions overlap; else None.

    Reads the ids alone and fetches a row for each partition."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = last = None
        ascending = True
        for batch in batches:
            ids = batch.column("doc_id")
            if not len(ids):
                continue
            ascending = ascending and not ids.null_count
            if ascending:
                values = ids.to_numpy()
                ascending = bool((np.diff(values) > 0).all()) and (last is None or last < values[0])
                first, last = (int(values[0]) if first is None else first), int(values[-1])
        if first is not None or not ascending:
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "last": last, "ascending": ascending}], schema=pa.schema([("part", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("ascending", pa.bool_())]))

    parts = rows.select("doc_id").mapInArrow(ends, "part int, first long, last long, ascending boolean").collect()
    if not all(r.ascending for r in parts):
        return None
    parts.sort(key=lambda r: r.first)
    if any(a.last >= b.first for a, b in zip(parts, parts[1:], strict=False)):
        return None
    return {r.part: k for k, r in enumerate(parts)}


def _in_order(spark: SparkSession, path: str) -> bool:
    """Whether the shards written are ascending in themselves and one after the other."""
    shards = spark.read.schema(BLOCK_SCHEMA).parquet(path).groupBy("shard").agg(F.min("first_id").alias("a"), F.max("last_id").alias("b"), F.bool_and("ascending").alias("ok"), F.count_distinct("task").alias("tasks")).orderBy("shard").collect()
    return all(r.ok and r.tasks == 1 for r in shards) and all(x.b < y.a for x, y in zip(shards, shards[1:], strict=False))


def _block_writer(tokenizer: str, end_id: int, ranks: dict[int, int] | None):
    """A function of a task's rows that yields its blocks. ranks gives the shard of each partition, by default its own number."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block = TaskContext.get().partitionId(), 0
        shard = task if ranks is None else ranks.get(task, -1)
        encode = encoder(tokenizer, drops_space=False)
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        ids: list[int | None] = []
        held: list[bytes] = []
        tokens, before, ascending = 0, None, True

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in held], dtype=np.int64)
            low, low_bits, high, select = EliasFano.encode(np.cumsum(lengths))
            packed, nulls = pack_ids(ids)
            body = np.frombuffer(b"".join(held), dtype="<u4").astype(f"<u{width}").tobytes()
            named = [x for x in ids if x is not None]
            row = [shard, block, task, min(named, default=None), max(named, default=None), ascending, packed, nulls, len(ids), int(lengths.sum()), width, body, low, low_bits, high, select]
            return pa.RecordBatch.from_pylist([dict(zip(_names(BLOCK_SCHEMA), row, strict=True))], schema=_arrow(BLOCK_SCHEMA))

        for keys, texts in encoded(batches, encode):
            for key, raw in zip(keys, texts, strict=True):
                size = len(raw) // 4 + 1
                if held and tokens + size > BLOCK_TOKENS:
                    yield flush()
                    ids, held, tokens, block = [], [], 0, block + 1
                ascending = ascending and key is not None and (before is None or before < key)
                before = key
                ids.append(key)
                held.append(raw + end)
                tokens += size
        if held:
            yield flush()

    return blocks


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the store: doc_id, start (ids of all documents before it), n_tokens, and ids_crc32 of its
    ids as little-endian unsigned 32-bit integers or, with_ids, the ids themselves."""
    schema = TOKEN_SCHEMA if with_ids else ROW_SCHEMA

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a block at a time, as each holds about a million ids
                (r,) = batch.slice(k, 1).to_pylist()
                cuts = list(EliasFano(r["low"], r["low_bits"], r["high"], r["select"], r["n_docs"]).spans())
                body = np.frombuffer(r["ids"], dtype=f"<u{r['width']}").astype("<u4")
                raw = memoryview(body.tobytes())
                last = pa.array([body[a:b].astype(np.int32) for a, b in cuts], pa.list_(pa.int32())) if with_ids else pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in cuts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * len(cuts), pa.int32()), pa.array([r["block"]] * len(cuts), pa.int32()), pa.array(range(len(cuts)), pa.int32()), pa.array(unpack_ids(r["doc_ids"], r["nulls"], r["n_docs"]), pa.int64()), pa.array([a for a, _ in cuts], pa.int64()), pa.array([b - a for a, b in cuts], pa.int64()), last],
                    schema=_arrow(schema),
                )

    store = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    rows = store.mapInArrow(documents, schema)
    starts = block_starts(store)
    kept = ["doc_id", (F.col("block_start") + F.col("local_start")).alias("start"), "n_tokens", "ids" if with_ids else "ids_crc32"]
    return rows.join(starts, ["shard", "block"]).select(*kept, "shard", "block", "pos")


def read_document(spark: SparkSession, path: str, number: int) -> list[int] | None:
    """The ids of the document at place `number` (from 0) of the store, or None beyond its end.

    Counts of documents by block tell its block; that block's select structure alone tells where it begins and ends."""
    store = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    shards = store.groupBy("shard").agg(F.sum("n_docs").alias("n")).orderBy("shard").collect()
    for s in shards:
        if number < s.n:
            break
        number -= s.n
    else:
        return None
    for b in store.where(F.col("shard") == s.shard).select("block", "n_docs").orderBy("block").collect():
        if number < b.n_docs:
            r = store.where((F.col("shard") == s.shard) & (F.col("block") == b.block)).select("width", "ids", "low", "low_bits", "high", "select", "n_docs").first()
            ends = EliasFano(bytes(r["low"]), r["low_bits"], bytes(r["high"]), bytes(r["select"]), r["n_docs"])
            a, z = ends.select(number - 1) if number else 0, ends.select(number)
            return np.frombuffer(r["ids"], dtype=f"<u{r['width']}")[a:z].tolist()
        number -= b.n_docs
    return None


def block_starts(store: DataFrame) -> DataFrame:
    """(shard, block, block_start): running sums in two levels, so that no task sees more rows than a shard has blocks or
    the store has shards. A block holds about a million ids, so the counts are some millionth of the data."""
    sizes = store.select("shard", "block", "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = sizes.select("shard", "block", before(Window.partitionBy("shard").orderBy("block")).alias("in_shard"))
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    return inside.join(shards, "shard").select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("block_start"))


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
