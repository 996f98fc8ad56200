"""Product codes of vectors by filtering Lloyd: kd-trees hand whole boxes of vectors to their nearest codebook entry.

A vector's components become integers and are cut into equal parts; each part position has a codebook of its own. A task
takes CHUNK_BYTES of vectors at a time and builds one kd-tree for each part position, whose nodes hold their box, their
count and their sum. The trees are written once, in the shared folder, and read again in every round.

In a round all tasks know the codebooks (entries times dimensions: a bound that the parameters set). A tree is walked level by
level with the entries that may still be nearest for each node: an entry that is farther than the one nearest to the box's
middle, even from the corner that suits it best, is dropped. A node that is left with one entry is assigned whole, by its sum
and count; a leaf that is left with several looks at its vectors. All of it is done in integers, so a round equals a plain
assignment of every vector, ties to the lower index included. A task sends one row for each entry and component.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a leaf at most.
LEAF = 16
#: Bytes of vectors, as 64-bit integers, that share trees.
CHUNK_BYTES = 2 << 20


@dataclass
class Tree:
    """points lie in leaf order, order gives their places in the chunk. Level k has 2**k nodes: node i holds the points
    from edges[k][i] to edges[k][i + 1], its children are 2i and 2i + 1 of the next level."""

    points: np.ndarray
    order: np.ndarray
    edges: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]


def build(points: np.ndarray) -> Tree:
    """The tree of n >= 1 points (n, d): every node is cut at the median of its box's longest side."""
    order, edges = np.arange(len(points)), np.array([0, len(points)])
    every, lows, highs = [], [], []
    while True:
        own = points[order]
        low, high = np.minimum.reduceat(own, edges[:-1]), np.maximum.reduceat(own, edges[:-1])
        every.append(edges)
        lows.append(low)
        highs.append(high)
        sizes = np.diff(edges)
        if sizes.max() <= LEAF:
            break
        node = np.repeat(np.arange(len(sizes)), sizes)
        order = order[np.lexsort((points[order, (high - low).argmax(axis=1)[node]], node))]
        edges = np.append(np.stack([edges[:-1], (edges[:-1] + edges[1:]) // 2], axis=1).ravel(), edges[-1])
    own = points[order]
    return Tree(own, order, every, lows, highs, [np.add.reduceat(own, e[:-1]) for e in every])


def walk(tree: Tree, book: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Steps (level, nodes, entries, None), each node of which belongs whole to the entry beside it, and (-1, points, entries,
    distances) of points that were looked at one by one."""
    nodes, alive = np.zeros(1, dtype=np.int64), np.ones((1, len(book)), dtype=bool)
    far = np.iinfo(np.int64).max
    for level, edges in enumerate(tree.edges):
        low, high = tree.low[level][nodes, None], tree.high[level][nodes, None]
        middle = np.where(alive, ((2 * book - low - high) ** 2).sum(axis=2), far)
        star = middle.argmin(axis=1)
        best = book[star][:, None]
        corner = np.where(book > best, high, low)
        theirs, its = ((book - corner) ** 2).sum(axis=2), ((best - corner) ** 2).sum(axis=2)
        # the difference of two distances is linear over the box and least in that corner; ties go to the lower index
        alive &= ~((theirs > its) | (theirs == its) & (np.arange(len(book)) > star[:, None]))
        one = alive.sum(axis=1) == 1
        if one.any():
            yield level, nodes[one], alive[one].argmax(axis=1), None
        nodes, alive = nodes[~one], alive[~one]
        if not len(nodes):
            return
        if level + 1 < len(tree.edges):
            nodes, alive = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel(), np.repeat(alive, 2, axis=0)
            continue
        sizes = edges[nodes + 1] - edges[nodes]
        leaf = np.repeat(np.arange(len(nodes)), sizes)
        at = edges[nodes][leaf] + np.arange(len(leaf)) - (np.cumsum(sizes) - sizes)[leaf]
        apart = np.where(alive[leaf], ((tree.points[at, None].astype(np.int64) - book) ** 2).sum(axis=2), far)
        entry = apart.argmin(axis=1)
        yield -1, at, entry, apart[np.arange(len(at)), entry]


def moved(tree: Tree, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Adds the tree's points to the sums (entries, d) and counts (entries) of their nearest entries."""
    for level, at, entry, _ in walk(tree, book):
        if level < 0:
            np.add.at(sums, entry, tree.points[at].astype(np.int64))
            np.add.at(counts, entry, 1)
        else:
            np.add.at(sums, entry, tree.sums[level][at])
            np.add.at(counts, entry, tree.edges[level][at + 1] - tree.edges[level][at])


def assigned(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point of the chunk and its squared distance, in the chunk's order."""
    n = len(tree.points)
    entries, apart = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for level, at, entry, distance in walk(tree, book):
        if level >= 0:
            start, size = tree.edges[level][at], tree.edges[level][at + 1] - tree.edges[level][at]
            entry = np.repeat(entry, size)
            at = np.repeat(start, size) + np.arange(len(entry)) - np.repeat(np.cumsum(size) - size, size)
            distance = ((tree.points[at].astype(np.int64) - book[entry]) ** 2).sum(axis=1)
        entries[tree.order[at]], apart[tree.order[at]] = entry, distance
    return entries, apart


def whole_vectors(rows: DataFrame, vector: str, parts: int = PARTS) -> DataFrame:
    """The rows whose vector has a length that `parts` divides and no null, NaN or infinite component."""
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0)).where(usable)


def whole_numbers(vector: Column, most: int, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as longs; components beyond `most` are an error, as sums of squares would overflow."""
    number = lambda x: F.floor(x.cast("double") * scale)
    checked = lambda n: F.when(F.abs(n) <= most, n).otherwise(F.raise_error(F.lit(f"a component beyond {most} / {scale}")).cast("long"))
    return F.transform(vector, lambda x: checked(number(x)))


def forest(rows: DataFrame, parts: int) -> DataFrame:
    """A row for each chunk of rows (vec_id, label, v): members (vec_id, label) and one pickled tree for each part."""
    kind = f"array<struct<vec_id:{rows.schema['vec_id'].dataType.simpleString()},label:{rows.schema['label'].dataType.simpleString()}>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            v = table.column("v").flatten().to_numpy().reshape(table.num_rows, -1)
            members = pa.ListArray.from_arrays([0, table.num_rows], pa.StructArray.from_arrays([table.column("vec_id"), table.column("label")], names=["vec_id", "label"]))
            trees = [pickle.dumps(build(x)) for x in np.split(v, parts, axis=1)]
            return pa.RecordBatch.from_arrays([members, pa.array([trees], pa.list_(pa.binary()))], names=["members", "trees"])

        for batch in batches:
            while batch.num_rows:
                each = 8 * len(batch.column("v")[0])
                take = max(1, min(batch.num_rows, (CHUNK_BYTES - size) // each))
                held.append(batch.slice(0, take))
                batch, size = batch.slice(take), size + take * each
                if size + each > CHUNK_BYTES:
                    yield chunk()
                    held, size = [], 0
        if held:
            yield chunk()

    return rows.select("vec_id", "label", "v").mapInArrow(run, f"members {kind}, trees array<binary>")


def improved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, d) after one round."""
    parts, entries, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for p, tree in enumerate(row):
                    moved(pickle.loads(tree.as_buffer()), books[p], sums[p], counts[p])
        place = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(place, d)), pa.array(np.tile(np.arange(d), len(place))), pa.array(sums.reshape(-1, d)[place].ravel()), pa.array(np.repeat(counts.ravel()[place], d))], names=["place", "component", "total", "n"])

    found = trees.select("trees").mapInArrow(run, "place long, component long, total long, n long")
    books = books.reshape(-1, d).copy()
    for r in found.groupBy("place", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        books[r.place, r.component] = r.total // r.n
    return books.reshape(parts, entries, d)


def coded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector in the trees."""
    member = trees.schema["members"].dataType.elementType
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in member)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, row in zip(batch.column("members"), batch.column("trees"), strict=True):
                entries, apart = zip(*[assigned(pickle.loads(tree.as_buffer()), books[p]) for p, tree in enumerate(row)], strict=True)
                codes = np.stack(entries, axis=1).astype(np.uint8)
                rows = members.values
                yield pa.RecordBatch.from_arrays([rows.field("vec_id"), rows.field("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(np.sum(apart, axis=0))], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, f"{kind}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector that can be coded.

    code has two hexadecimal digits for each part, so there are 256 entries at most. Left out are null vectors, those with a
    null, NaN or infinite component, those whose length `parts` does not divide, and those of another length than that of the
    smallest vec_id kept. Fewer vectors than entries make smaller codebooks. Repeated ids are vectors of their own, in the order
    of their components; null ids come last. label_error adds up equal labels, nulls together. Extra columns are ignored, an
    empty table gives an empty result. A component so large that squared distances might not fit 64 bits is an error."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    spark = vectors.sparkSession
    common.small_text_batches(spark)
    rows = whole_vectors(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("v")), "v", parts)
    by_id = [F.asc_nulls_last("vec_id"), F.col("v")]
    first = rows.orderBy(*by_id).select(F.size("v")).first()
    kind = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if first is None:
        return spark.createDataFrame([], kind)
    d = first[0] // parts
    numbers = whole_numbers(F.col("v"), math.isqrt((1 << 62) // d) // 4, scale)
    rows = rows.where(F.size("v") == first[0]).withColumn("v", numbers)
    start = np.array([r.v for r in rows.orderBy(*by_id).limit(entries).select("v").collect()], dtype=np.int64)
    books = start.reshape(len(start), parts, d).transpose(1, 0, 2).copy()
    # Parquet looks at a row group's size after so many rows: a chunk is a large row
    trees = common.stored(forest(rows, parts), "trees", **{"parquet.block.size.row.check.min": "4", "parquet.block.size.row.check.max": "8"})
    for _ in range(rounds):
        books = improved(trees, books)
    found = common.stored(coded(trees, books).withColumn("_label", F.to_json(F.struct("label"))), "codes")
    totals = common.stored(found.groupBy("_label").agg(F.sum("error").alias("label_error")), "totals")
    out = common.joined(found, totals, "_label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
