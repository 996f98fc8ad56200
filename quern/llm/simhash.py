"""SimHash near duplicates by a binary trie self-join.

Fingerprints live in a binary trie over their 64 bits. The self-join walks pairs of nodes down together: a pair whose
prefixes differ in more bits than the budget is dropped with all below it. The walk is level-synchronous over arrays
of node pairs, where a node is a range of a sorted fingerprint array, so one numpy step moves every pair a bit down.

On a cluster the trie is dealt out by blocks: two fingerprints within `budget` bits agree on one of budget + 1 blocks of
their bits, so each fingerprint goes to budget + 1 subtries, named by block and its value. Only distinct fingerprints
go there. A subtrie that still holds more than SUBTRIE_ROWS of them is dealt out again by blocks of its other bits,
which keeps any one task's share small whatever the data. A subtrie returns a spanning forest of its links, not
all pairs; connected components are then found by alternating large-star and small-star steps on stored tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

BITS = 64
BUDGET = 3
SHINGLE_WORDS = 3
SEED = 42
#: Fingerprints of a subtrie beyond which it is dealt out once more.
SUBTRIE_ROWS = 10_000
#: Times a subtrie may be dealt out again: each fixes a (budget + 1)-th of the bits that are left. That parts fingerprints
#: that merely share a block; what still meets after it lies within a few bits, and dealing it again would only copy it.
DEALS = 2
#: Node pairs, or pairs of fingerprints, that are handled together.
PAIRS_AT_ONCE = 200_000
#: A node pair of at most so many pairs of fingerprints is compared directly.
LEAF_PAIRS = 64
#: Hashes whose bits are counted together.
HASHES_AT_ONCE = 1 << 16


def words_of(text: str) -> list[bytes]:
    """Maximal runs of anything but the six ASCII white-space characters, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each run of `width` words joined by spaces; of the whole sequence if it is shorter; none of no words."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-width].tolist()]
    stops = (ends[width - 1 :] - 1).tolist()
    return np.array([xxh64_intdigest(text[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in more than half of the hashes; 0 for none. Counts are exact for any number of them."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[i : i + HASHES_AT_ONCE]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for each row of docs (doc_id, text); fp holds the 64 bits as a signed long."""
    common.small_text_batches(docs.sparkSession)

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(shingle_hashes(words_of(t), width)) for t in common.strings(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def trie_links(groups: np.ndarray, prints: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i before j, of prints in the same group whose fingerprints differ in at most budget bits, in
    bounded batches. groups and prints are sorted by (group, print); prints of a group are distinct."""
    edges = np.flatnonzero(np.diff(groups)) + 1
    lo, hi = np.concatenate([[0], edges]), np.concatenate([edges, [len(groups)]])
    many = hi - lo > 1
    zero = np.zeros(int(many.sum()), dtype=np.int64)
    stack = [(zero, lo[many], hi[many], lo[many], hi[many], zero)]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > PAIRS_AT_ONCE:
            half = len(alo) // 2
            stack += [tuple(x[half:] for x in (depth, alo, ahi, blo, bhi, diff)), tuple(x[:half] for x in (depth, alo, ahi, blo, bhi, diff))]
            continue
        na, nb = ahi - alo, bhi - blo
        small = na * nb <= LEAF_PAIRS
        chosen = np.flatnonzero(small)
        for k in range(0, len(chosen), PAIRS_AT_ONCE // 16):
            part = chosen[k : k + PAIRS_AT_ONCE // 16]
            n = na[part] * nb[part]
            node = np.repeat(part, n)
            within = np.arange(len(node)) - np.repeat(np.cumsum(n) - n, n)
            i, j = alo[node] + within // nb[node], blo[node] + within % nb[node]
            near = (i < j) & (np.bitwise_count(prints[i] ^ prints[j]) <= budget)
            if near.any():
                yield i[near], j[near]
        go = ~small
        if not go.any():
            continue
        depth, alo, ahi, blo, bhi, diff = (x[go] for x in (depth, alo, ahi, blo, bhi, diff))
        # every pair moves at least to the first bit where one of its two ranges splits or the two differ
        spread = (prints[alo] ^ prints[ahi - 1]) | (prints[blo] ^ prints[bhi - 1]) | (prints[alo] ^ prints[blo])
        depth = np.maximum(depth, _leading_zeros(spread & _below(depth)))
        bit = np.uint64(1) << (BITS - 1 - depth).astype(np.uint64)
        amid, bmid = _split(prints, alo, ahi, bit), _split(prints, blo, bhi, bit)
        other = alo != blo
        parts = [
            (alo, amid, blo, bmid, diff, None),
            (amid, ahi, bmid, bhi, diff, None),
            (alo, amid, bmid, bhi, diff + 1, None),
            (amid, ahi, blo, bmid, diff + 1, other),
        ]
        below = []
        for a0, a1, b0, b1, d, only in parts:
            alive = (a1 > a0) & (b1 > b0) & (d <= budget)
            if only is not None:
                alive &= only
            below.append((depth[alive] + 1, a0[alive], a1[alive], b0[alive], b1[alive], d[alive]))
        level = tuple(np.concatenate(x) for x in zip(*below, strict=True))
        if len(level[0]):
            stack.append(level)


def _below(depth: np.ndarray) -> np.ndarray:
    """Masks of the bits at depth and deeper; empty at the depth of BITS."""
    full = np.full(len(depth), np.uint64(0xFFFFFFFFFFFFFFFF))
    return np.where(depth >= BITS, np.uint64(0), full >> np.minimum(depth, BITS - 1).astype(np.uint64))


def _leading_zeros(x: np.ndarray) -> np.ndarray:
    """Leading zero bits of 64-bit values, at most BITS - 1."""
    out = np.zeros(len(x), dtype=np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        empty = x >> np.uint64(BITS - step) == 0
        out += np.where(empty, step, 0)
        x = np.where(empty, x << np.uint64(step), x)
    return np.minimum(out, BITS - 1)


def _split(prints: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The first index of each sorted range whose bit is set (all bits above it agree within the range)."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        high = open_ & (prints[np.minimum(mid, len(prints) - 1)] & bit != 0)
        hi = np.where(high, mid, hi)
        lo = np.where(open_ & ~high, mid + 1, lo)
    return lo


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index that links join each of n to: hooking and pointer jumping, batch by batch."""
    root = np.arange(n)
    for left, right in links:
        while len(left):
            a, b = root[left], root[right]
            apart = a != b
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def block_masks(fixed: int, parts: int) -> list[int]:
    """The bits outside `fixed`, high to low, cut into `parts` near-equal runs."""
    free = [i for i in range(BITS - 1, -1, -1) if not fixed >> i & 1]
    cuts = [round(k * len(free) / parts) for k in range(parts + 1)]
    return [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def deal(rows: DataFrame, fixed: list[int], budget: int) -> tuple[DataFrame, list[int]]:
    """Each row (fp[, k]) once for each block: k numbers the mask of bits that a subtrie has in common, key holds them."""
    masks, cases = [], []
    for k, f in enumerate(fixed):
        blocks = [f | m for m in block_masks(f, budget + 1)]
        cases.append(F.array(*[F.struct(F.lit(len(masks) + i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(blocks)]))
        masks += blocks
    chosen = cases[0]
    for k in range(1, len(cases)):
        chosen = F.when(F.col("k") == k, cases[k]).otherwise(chosen)
    return rows.select("fp", F.explode(chosen).alias("b")).select("fp", "b.k", "b.key"), masks


def links(prints: DataFrame, budget: int = BUDGET, subtrie_rows: int = SUBTRIE_ROWS) -> DataFrame:
    """A spanning forest (a, b), b < a in unsigned order, of the links among distinct fingerprints (column fp).

    Joined over all subtries the forests connect exactly the fingerprints that chains of links connect. A wide budget makes
    blocks short and prunes little, so it wants smaller subtries."""
    rows, masks = deal(prints, [0], budget)
    out = None
    for again in range(DEALS + 1):
        rows = common.stored(rows, "subtries")
        sizes = rows.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n"))
        large = common.stored(sizes.where(F.col("n") > subtrie_rows).select("k", "key", "n"), "large")
        split = again < DEALS and len(masks) * (budget + 1) <= 4096 and not large.isEmpty()
        small = rows.join(large, ["k", "key"], "left_anti") if split else rows
        found = _joined(small, budget)
        out = found if out is None else out.unionByName(found)
        if not split:
            break
        rows, masks = deal(rows.join(large, ["k", "key"], "left_semi"), masks, budget)
    return out


def _joined(rows: DataFrame, budget: int) -> DataFrame:
    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            group, fp = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            end = len(group) if last else int(np.argmax((group == group[-1]).all(axis=1)))  # the last subtrie may go on
            held, size = ([(group[end:], fp[end:])], len(fp) - end) if end < len(fp) else ([], 0)
            group, fp = group[:end], fp[:end].view(np.uint64)
            if not len(fp):
                return
            number = np.concatenate([[0], np.cumsum((np.diff(group, axis=0) != 0).any(axis=1))])
            order = np.lexsort((fp, number))
            number, fp = number[order], fp[order]
            root = forest(len(fp), trie_links(number, fp, budget))
            moved = np.flatnonzero(root != np.arange(len(root)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(fp[moved].view(np.int64)), pa.array(fp[root[moved]].view(np.int64))], names=["a", "b"])

        for batch in batches:
            k, key, fp = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("k", "key", "fp"))
            held.append((np.stack([k, key], axis=1), fp))
            size += len(fp)
            if size >= PAIRS_AT_ONCE:
                yield from flush(False)
        if held:
            yield from flush(True)

    dealt = rows.repartition("k", "key").sortWithinPartitions("k", "key")
    return dealt.select("k", "key", "fp").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, root): the smallest node (signed order) that chains of edges (a, b) reach; nodes without an edge are absent.

    Large-star and small-star steps alternate until nothing moves: a logarithm of the largest component's size in practice.
    Edges point from the larger node to the smaller and each step is stored, so lineage stays short. A node with many
    neighbours sends them through partial minima, and its neighbours are never gathered in one task."""
    edges = common.stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = common.stored(large, label)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        small = common.stored(small, label)
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        edges = small


def near_duplicates(docs: DataFrame, budget: int = BUDGET, width: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that chains of links reach. Null and blank texts have fingerprint zero and link
    like any other; null ids are ignored in minima and a component with no other id has a null one. Extra columns are
    ignored, repeated rows repeat, an empty table gives an empty result."""
    prints = common.stored(fingerprints(docs, width), "prints")
    nodes = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    roots = common.stored(components(links(nodes.select("fp"), budget)), "roots")
    with_root = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    smallest = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.stored(with_root.join(smallest, "root").select("fp", "n", "component_id"), "named")
    total = prints.count()
    least = max(2, -(-total // 1000))
    heavy = F.broadcast(named.where(F.col("n") >= least).drop("n"))  # a thousand rows at most
    hot = prints.join(heavy, "fp")
    cold = prints.join(heavy.select("fp"), "fp", "left_anti").join(named.where(F.col("n") < least).drop("n"), "fp")
    return hot.unionByName(cold).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
