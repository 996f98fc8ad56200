"""Near copies by Jaccard similarity: the trie self-join of SimHash fingerprints and, beyond its budget, MinHash bands propose
pairs; exact sets of five-word shingles decide.

Texts of equal shingle sets are one node. A node's fingerprint is that of op9, over its set. The trie self-join (`simhash.links`)
links fingerprints within TRIE_BUDGET bits, as a spanning forest; its links are held against the sets, and those that stand
make the first components. A pair of SIMILARITY may lie further apart than any budget that a trie prunes by, so bands then look
for pairs between those components, and none within them is compared again.

A node's MinHash signature is cut into BANDS bands of BAND_ROWS values; nodes
that share a band are a bucket. A bucket of at most ALL_PAIRS nodes proposes all its pairs; a larger one proposes each
node with the bucket's PIVOTS, which differ from bucket to bucket, so that pairs grow with the nodes and not with their
square, and near copies, which share many buckets, meet many pivots. Proposed pairs are held against each other by the
exact Jaccard similarity of their sets, and links of SIMILARITY or more are followed to connected components.

Pivots settle nearly all of a large bucket, and the rest is done exactly. Nodes of a large bucket that links have not made
one component meet by prefixes: with shingles ordered from rare to frequent, two sets of SIMILARITY or more share one of
the first of either. How frequent a shingle is, a table of SLOTS counters tells, which all tasks know, so a set is put in
order where it lies and only its prefix is shuffled. Sets with a common frequent part, but rare shingles of their own, never
meet there; of those that do, only nodes of unlike components whose sizes and places leave room for enough shared shingles
are compared.

A pair at similarity s shares a band with probability 1 - (1 - s**BAND_ROWS)**BANDS: 0.9998 at 0.8, more above. No pair that
shares a band is lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common, simhash

WIDTH = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 16, 4
ALL_PAIRS = 24
#: Bits by which fingerprints of the trie self-join may differ: the median of pairs of 0.8 or more lies at 6 to 7.
TRIE_BUDGET = 7
#: Fingerprints of a subtrie beyond which it is dealt out once more.
SUBTRIE_ROWS = 2_000
#: What node keys are turned by to choose a bucket's pivots.
PIVOTS = (0x243F6A8885A308D3, 0x13198A2E03707344)
#: Counters of shingles; unlike shingles may share one, which costs a worse order and no result.
SLOTS = 1 << 20
#: Shingles whose MinHash values are formed together; bounds the work array of a very long text.
SHINGLES_AT_ONCE = 1 << 12
MULTIPLIERS = np.random.default_rng(11).integers(0, 1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
MASKS = np.random.default_rng(12).integers(0, 1 << 63, size=BANDS * BAND_ROWS, dtype=np.uint64)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted set of hashes of the text's runs of `width` words; of all words if they are fewer; empty without words."""
    return np.unique(simhash.shingle_hashes(simhash.words_of(text), width))


def node_key(found: np.ndarray) -> int:
    """A signed long that stands for the set."""
    from xxhash import xxh3_64_intdigest

    return simhash._signed(xxh3_64_intdigest(found.tobytes()))


def signature(found: np.ndarray, masks: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    least = np.full(len(masks), np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(found), SHINGLES_AT_ONCE):
        part = found[i : i + SHINGLES_AT_ONCE, None]
        np.minimum(least, ((part ^ masks) * multipliers).min(axis=0), out=least)
    return least


def bands(found: np.ndarray) -> list[int]:
    """A signed long for each band of the set's signature; none of an empty set."""
    from xxhash import xxh3_64_intdigest

    if not len(found):
        return []
    least = signature(found, MASKS, MULTIPLIERS)
    return [simhash._signed(xxh3_64_intdigest(row.tobytes(), k)) for k, row in enumerate(least.reshape(BANDS, BAND_ROWS))]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; 1 of two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def signed_texts(docs: DataFrame, width: int = WIDTH, keys: Callable[[np.ndarray], list[int]] = bands, prints: bool = False) -> DataFrame:
    """(doc_id, digest, node, size, bands[, fp]) for each row of docs (doc_id, digest, text): size is that of the set of
    shingles, bands are the keys of buckets that `keys` makes of it, fp is its SimHash fingerprint as a signed long."""
    names = ["doc_id", "digest", "node", "size", "bands", *["fp"] * prints]

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in common.strings(batch.column("text"))]
            columns = [pa.array([node_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([keys(s) for s in sets], pa.list_(pa.int64()))]
            if prints:
                columns.append(pa.array([simhash._signed(simhash.fingerprint(s)) for s in sets], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *columns], names=names)

    return docs.select("doc_id", "digest", "text").mapInArrow(run, "doc_id long, digest long, node long, size long, bands array<long>" + ", fp long" * prints)


def sets_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, shingles) for each row of docs (text); shingles holds the sorted hashes as bytes."""

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in common.strings(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array([node_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node long, shingles binary")


def _maybe(df: DataFrame, column: Column, keys: DataFrame) -> DataFrame:
    """The rows of df whose column may be among keys (one column of longs)."""
    words = common.filter_words(keys.count())
    hashes = keys.select(F.xxhash64(keys.columns[0]).alias("h"))
    return common.maybe_member(df, F.xxhash64(column), common.membership_filter(hashes, words), words, "_quern_maybe").where("_quern_maybe").drop("_quern_maybe")


def room(size_a: Column, size_b: Column) -> Column:
    """False if sets of these sizes cannot have SIMILARITY."""
    return F.least(size_a, size_b) >= F.greatest(size_a, size_b) * F.lit(SIMILARITY) - F.lit(1e-6)


def trie_pairs(nodes: DataFrame, budget: int = TRIE_BUDGET) -> DataFrame:
    """Distinct pairs (a, b), a < b, of nodes (node, size, fp) that the trie self-join of their fingerprints links: its spanning
    forest between the least nodes of fingerprints, and each other node of a fingerprint with the least. Empty sets have none."""
    full = nodes.where("size > 0").select("node", "fp")
    least = common.stored(full.groupBy("fp").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")), "prints")
    forest = common.stored(simhash.links(least.select("fp"), budget, SUBTRIE_ROWS), "forest").toDF("fp", "other").distinct()
    other = least.select(F.col("fp").alias("other"), F.col("least").alias("b"))
    between = forest.join(least.select("fp", F.col("least").alias("a")), "fp").join(other, "other").select("a", "b")
    within = common.joined(full, least.where("n > 1").select("fp", "least"), "fp").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    both = between.unionByName(within)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes roots (node, root; only nodes with a link) do not put into one component."""
    for x in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")), x, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def proposed(nodes: DataFrame, pivots: int = len(PIVOTS)) -> tuple[DataFrame, DataFrame]:
    """Of nodes (node, size, bands): distinct pairs (a, b), a < b, all of small buckets (but those whose sizes rule them out)
    and those with one of the `pivots` of large ones; and (bucket, node) of large buckets."""
    dealt = common.stored(nodes.select("node", "size", F.explode("bands").alias("bucket")), "bands")
    # a pivot is the least of the bucket's keys after they are turned, which partial minima find in fixed-width buffers
    turn = [F.lit(simhash._signed(p)).bitwiseXOR(F.col("bucket")) for p in PIVOTS[:pivots]]
    least = [F.min(F.col("node").bitwiseXOR(t)).alias(f"p{k}") for k, t in enumerate(turn)]
    found = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *least).where("n > 1")
    buckets = common.stored(found.select("bucket", "n", F.array(*[F.col(f"p{k}").bitwiseXOR(t) for k, t in enumerate(turn)]).alias("pivots")), "buckets")
    shared = common.stored(_maybe(dealt, F.col("bucket"), buckets.select("bucket")), "shared")
    met = common.stored(common.joined(shared, buckets, "bucket"), "met")
    small = met.where(F.col("n") <= ALL_PAIRS)
    a, b = (small.select("bucket", F.col("node").alias(x), F.col("size").alias(f"size_{x}")) for x in "ab")
    all_pairs = a.join(b, "bucket").where("a < b").where(room(F.col("size_a"), F.col("size_b"))).select("a", "b")
    large = met.where(F.col("n") > ALL_PAIRS).select("node", F.explode("pivots").alias("pivot")).where("node != pivot")
    pairs = all_pairs.unionByName(large.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))).distinct()
    return pairs, met.where(F.col("n") > ALL_PAIRS).select("bucket", "node")


def _slots(found: np.ndarray) -> np.ndarray:
    """A shingle hash's counter. The hashes are even enough for their high bits to serve."""
    return (found >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def frequencies(sets: DataFrame) -> np.ndarray:
    """SLOTS counters of the shingles of all sets (shingles): each task adds up its own, so SLOTS rows a task are shuffled at
    most, and as many reach the driver."""

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for x in batch.column("shingles"):
                np.add.at(counts, _slots(np.frombuffer(x.as_buffer(), dtype=np.uint64)), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["slot", "n"])

    found = sets.select("shingles").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, dtype=np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def prefix_size(size: int) -> int:
    """How many of a set's first shingles, in any order that all sets follow, a set of SIMILARITY or more shares one of."""
    return size - math.ceil(size * SIMILARITY - 1e-6) + 1


def prefixes(sets: DataFrame, counts: np.ndarray) -> DataFrame:
    """(node, root, size, place, shingle) of sets (node, root, shingles): the rarest of each, place from 1."""
    known = sets.sparkSession.sparkContext.broadcast(counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts)

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first = [], []
            for x in batch.column("shingles"):
                found = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                order = np.lexsort((found, known.value[_slots(found)]))
                sizes.append(len(found))
                first.append(found[order[: prefix_size(len(found))]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("root"), pa.array(sizes, pa.int64()), pa.array(first, pa.list_(pa.int64()))], names=["node", "root", "size", "first"])

    out = sets.select("node", "root", "shingles").mapInArrow(run, "node long, root long, size long, first array<long>")
    return out.select("node", "root", "size", F.posexplode("first").alias("place", "shingle")).withColumn("place", F.col("place") + 1)


def unsettled(large: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, that share a prefix shingle, of nodes that stand in a large bucket (bucket, node) with
    several components and are of different ones. roots (node, root) lacks nodes without a link."""
    rooted = common.stored(large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    several = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("bucket")
    rest = common.stored(_maybe(rooted, F.col("bucket"), common.stored(several, "several")).join(several, "bucket", "left_semi").select("node", "root").distinct(), "rest")
    held = common.stored(sets.join(rest, "node").select("node", "root", "shingles"), "held")
    first = common.stored(prefixes(held, frequencies(held)), "prefixes")
    mixed = first.groupBy("shingle").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1").select("shingle")
    met = common.stored(first.join(mixed, "shingle", "left_semi"), "mixed")
    a, b = (met.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "size", "place")]) for x in "ab")
    # beyond the first shared shingle, only what follows it in both can be shared
    follow = 1 + F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    enough = follow >= (F.col("size_a") + F.col("size_b")) * F.lit(SIMILARITY / (1 + SIMILARITY)) - F.lit(1e-6)
    pairs = a.join(b, "shingle").where("node_a < node_b and root_a != root_b").where(room(F.col("size_a"), F.col("size_b")) & enough)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def links(docs: DataFrame, nodes: DataFrame, width: int = WIDTH, pivots: int = len(PIVOTS)) -> DataFrame:
    """(a, b) of nodes (node, least, size, bands[, fp]) whose sets have SIMILARITY or more, enough of them to join all that any of
    the proposed pairs joins: of the trie's pairs, where nodes have fingerprints; then of the bands' pairs that those leave apart;
    and then of those that large buckets leave unsettled. docs holds the texts by doc_id; only those of nodes in a pair are read again."""
    first = common.stored(trie_pairs(nodes), "trie") if "fp" in nodes.columns else None
    pairs, large = proposed(nodes, pivots)
    pairs, large = common.stored(pairs, "proposed"), common.stored(large, "large")
    every = pairs if first is None else pairs.unionByName(first)
    paired = common.stored(every.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "paired")
    ids = common.stored(_maybe(nodes.select("node", "least"), F.col("node"), paired).select("least").distinct(), "ids")
    texts = _maybe(docs, F.col("doc_id"), ids)
    sets = common.stored(sets_of(texts, width).join(paired, "node", "left_semi").dropDuplicates(["node"]), "sets")
    if first is None:
        found = common.stored(similar(pairs, sets), "links")
    else:
        linked = common.stored(similar(first, sets), "linked")
        left = common.stored(apart(pairs, common.stored(simhash.components(linked), "settled")), "apart")
        found = common.stored(linked.unionByName(similar(left, sets)), "links")
    if large.isEmpty():
        return found
    more = common.stored(unsettled(large, simhash.components(found), sets), "unsettled")
    return found.unionByName(similar(more, sets))


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets (node, shingles) have SIMILARITY or more."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    # once through each join: Spark splits the partitions of nodes with many pairs
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b")

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = ([np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in batch.column(c)] for c in ("of_a", "of_b"))
            near = pa.array([similarity(x, y) >= SIMILARITY for x, y in zip(of_a, of_b, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return both.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, component_id, keep_digest, times) for each document of docs (doc_id, text) with an id: rows that share
    id and text (its hash, digest) are one, `times` of them. component_id is the smallest doc_id that chains of links
    reach, keep_digest tells its text (the least hash, if several of the component share that id).

    Null and blank texts have an empty set and are one component. Rows without an id are not compared. Extra columns are
    ignored, an empty table gives an empty result."""
    common.small_text_batches(docs.sparkSession)
    docs = keyed(docs).where("doc_id is not null").select("doc_id", "text", "digest")
    texts = common.stored(signed_texts(docs, prints=True), "signed")
    nodes = common.stored(texts.groupBy("node").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("size", "bands", "fp")]), "nodes")
    roots = common.stored(simhash.components(common.stored(links(docs, nodes), "links")), "roots")
    with_root = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    smallest = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.stored(with_root.join(smallest, "root").select("node", "root", "component_id"), "named")
    rows = texts.groupBy("doc_id", "digest", "node").agg(F.count(F.lit(1)).alias("times"))
    found = common.stored(common.joined(rows, named, "node"), "found")
    # one text of each component's smallest id
    keep = common.stored(found.where("doc_id = component_id").groupBy("root").agg(F.min("digest").alias("keep_digest")), "keep")
    return common.joined(found, keep, "root").select("doc_id", "digest", "component_id", "keep_digest", "times")


def keyed(docs: DataFrame) -> DataFrame:
    """docs with doc_id as a long and digest, a hash of the text; all other columns pass through."""
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "digest": F.xxhash64(F.coalesce("text", F.lit("")))})


def without_near_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each component, that of the smallest id; all columns, whole texts.

    Rows are told apart by id and text: rows of one id with unlike texts have each their own fate, and of rows that repeat
    the staying one, one stays. Rows without an id stay. Documents without words have equal (empty) sets, so one stays."""
    judged = common.stored(near_copies(docs), "near")
    stays = (F.col("doc_id") == F.col("component_id")) & (F.col("digest") == F.col("keep_digest"))
    key = ["_quern_id", "_quern_digest"]
    rows = docs.withColumns({"_quern_id": F.col("doc_id").cast("long"), "_quern_digest": F.xxhash64(F.coalesce("text", F.lit("")))})
    gone = judged.where(~stays).select(F.col("doc_id").alias(key[0]), F.col("digest").alias(key[1]))
    again = judged.where(stays & (F.col("times") > 1)).select(F.col("doc_id").alias(key[0]), F.col("digest").alias(key[1]))
    left = common.without_rows(rows, gone, gone.count(), tuple(key))
    if not again.isEmpty():
        first = left.join(again, key, "left_semi").groupBy(*key).agg(F.first(F.struct(*docs.columns)).alias("_r")).select("_r.*")
        left = left.join(again, key, "left_anti").select(*docs.columns).unionByName(first)
    return left.select(*docs.columns)
