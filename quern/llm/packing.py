"""Best-fit packing by minimum bin slack.

Texts are tokenised and cut into pieces of at most `capacity` tokens. What has to be packed is then only how many pieces
have each length: at most `capacity` counts, however large the corpus. On those counts the driver fills one bin after
another: the longest piece left seeds the bin and a bitset dynamic programme over the lengths still available finds the
fullest feasible rest (slack is least, most often zero). The combination found is taken out as often as the counts
allow, so there are about as many rounds as lengths and the plan's size is bounded by the capacity, not by the data.
Pieces find their place in the plan by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quern.llm import common
from quern.llm.tokens import encoded, encoder

CAPACITY = 4096
TEXTS_AT_ONCE = 128
#: Pieces of one length that one task ranks.
RANKED_TOGETHER = 256
#: Buckets of one length whose sizes one task sums up; the sums of such parts are few.
SUMMED_TOGETHER = 10_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def fullest(lengths: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """From (length, how many) pairs, longest first: the (length, times) whose sum comes nearest to room from below.

    Bit s of `reach` tells whether sum s can be made. A length with count c enters as parts of 1, 2, 4, ... pieces, so
    any number up to c can be chosen. The search ends when room itself can be made."""
    if room <= 0:
        return []
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in lengths:
        left, part = min(count, room // length), 1
        while left > 0:
            part = min(part, left)
            wider = reach | reach << length * part & mask
            if wider != reach:
                steps.append((length, part, reach))
                reach = wider
            left -= part
            part *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + part
            total -= length * part
    return list(chosen.items())


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, [(length, times)]) patterns that use up the counts; a pattern's pieces lie in the order given."""
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c > 0}
    out = []
    while left:
        seed = next(iter(left))
        rest = [(n, c - (n == seed)) for n, c in left.items() if c > (n == seed)]
        chosen = {seed: 1}
        for n, times in fullest([x for x in rest if x[0] <= capacity - seed], capacity - seed):
            chosen[n] = chosen.get(n, 0) + times
        bins = min(left[n] // times for n, times in chosen.items())
        out.append((bins, sorted(chosen.items(), reverse=True)))
        for n, times in chosen.items():
            left[n] -= bins * times
            if not left[n]:
                del left[n]
    return out


class Places:
    """Where the r-th piece of a length goes: arrays by length, at most a few entries for each pattern of the plan."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        first = 0
        for bins, pattern in patterns:
            at = 0
            for n, times in pattern:
                by_length.setdefault(n, []).append((used.get(n, 0), times, first, at))
                used[n] = used.get(n, 0) + bins * times
                at += n * times
            first += bins
        self.by_length = {n: np.array(rows, dtype=np.int64).T for n, rows in by_length.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of each piece."""
        bin_id, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for n in np.unique(length):
            mine = np.flatnonzero(length == n)
            starts, times, first, at = self.by_length[int(n)]
            k = np.searchsorted(starts, rank[mine], side="right") - 1
            inside = rank[mine] - starts[k]
            bin_id[mine] = first[k] + inside // times[k]
            offset[mine] = at[k] + inside % times[k] * n
        return bin_id, offset


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]) of docs (doc_id, text). Null text counts as empty: one piece
    that holds the end id. Texts of any length are cut whole; repeated rows give repeated pieces."""
    common.small_text_batches(docs.sparkSession)
    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")

    @common.gives_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, drops_space=True), np.array([end_id], dtype="<u4").tobytes()
        for keys, texts in encoded(batches, encode):
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                rows: list[list] = [[], [], [], [], [], []]
                for key, raw in zip(keys[i : i + TEXTS_AT_ONCE], texts[i : i + TEXTS_AT_ONCE], strict=True):
                    raw += end
                    for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[a : a + 4 * capacity]
                        for column, value in zip(rows, (key, k, a // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(rows, kinds, strict=False)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(p, dtype="<u4").astype(np.int32) for p in rows[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(piece_rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, start, length and ids_crc32 (other columns pass through).

    The rows should be a stored table, as they are read twice. A length that very many pieces share is ranked in
    buckets, so no task holds more than about RANKED_TOGETHER of them. An empty table gives an empty result."""
    counts = {int(r.length): int(r.n) for r in piece_rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(plan(counts, capacity))
    # a common length is ranked in buckets of its own number; a long list of buckets is summed up in two levels
    buckets = F.create_map(*[x for n, c in counts.items() if c > RANKED_TOGETHER for x in (F.lit(n), F.lit(-(-c // RANKED_TOGETHER)))], F.lit(-1), F.lit(1))
    mine = F.coalesce(buckets[F.col("length").cast("int")], F.lit(1))
    rows = piece_rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), mine.cast("long")))
    sizes = common.stored(rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_part", (F.col("_bucket") / SUMMED_TOGETHER).cast("long")), "sizes")
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("length", "_part").agg(F.sum("_n").alias("_n")).select("length", "_part", before(Window.partitionBy("length").orderBy("_part")).alias("_earlier"))
    inside = sizes.select("length", "_part", "_bucket", before(Window.partitionBy("length", "_part").orderBy("_bucket")).alias("_within"))
    sizes = inside.join(parts, ["length", "_part"]).select("length", "_bucket", (F.col("_earlier") + F.col("_within")).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = rows.withColumn("_rank", F.row_number().over(order) - 1).join(sizes, ["length", "_bucket"])

    named = piece_rows.columns

    @common.gives_back
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_id, offset = places.of(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in named], pa.array(bin_id), pa.array(offset)], names=[*named, "sequence_id", "offset"])

    schema = StructType([*piece_rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.select(*named, (F.col("_rank") + F.col("_before")).alias("_rank")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenises, cuts and packs docs (doc_id, text). With with_ids each row also carries its ids.

    Null text counts as empty: one piece that holds the end id. Null ids stay null; repeated rows give repeated pieces,
    each with a place of its own; extra columns are ignored; an empty table gives an empty result."""
    return pack(common.stored(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of rows packed with_ids: the concatenated ids of each sequence, at most `capacity` long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
