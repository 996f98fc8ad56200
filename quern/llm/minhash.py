"""MinHash near duplicates by a multi-index Hamming join of b-bit signatures.

A set of shingles has a signature of CHUNKS * CHUNK values, the low BITS bits of its least hash under as many functions; the
distance of two signatures is the number of places where they differ. Signatures are cut into CHUNKS chunks of CHUNK
values. Two that differ in at most #: Sets of a large bucket that each of its sets is compared with first. With so many keys a set meets many buckets, so one will do.
PIVOTS = 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1 places have, by pigeonhole, a chunk with at most
ERRORS errors, and so agree on one of the chunk's variants that leave ERRORS of its places out. Each variant of each
chunk is a key; sets that share a key are candidates. No pair within DISTANCE is missed.

At similarity 0.8 a place differs with a probability of 0.2, and a pair is missed only if every chunk has more than ERRORS
errors: 0.3446**12 = 2.8e-6, and less above 0.8. Places that are equal by chance in their low bits only help.

Candidates go the way of `near_copies`: pairs within small buckets, pivots and then rare prefixes in large ones, and exact
similarity of the full sets for each. Hashes of 64 bits stand for shingles.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common, near_copies, simhash

WIDTH = 4
CHUNKS, CHUNK, ERRORS, BITS = 12, 6, 1, 16
#: Sets of a large bucket that each of its sets is compared with first. With so many keys a set meets many buckets, so one will do.
PIVOTS = 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Places of a chunk that a variant keeps, one row of flags for each variant.
VARIANTS = np.array([[k not in left for k in range(CHUNK)] for left in combinations(range(CHUNK), ERRORS)])
_random = np.random.default_rng(23)
MASKS = _random.integers(0, 1 << 63, size=CHUNKS * CHUNK, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
MULTIPLIERS = _random.integers(0, 1 << 63, size=CHUNKS * CHUNK, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
#: What a value counts in a key, by chunk and place, and what tells keys of unlike chunks and variants apart.
WEIGHTS = _random.integers(0, 1 << 63, size=(CHUNKS, CHUNK), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
SALTS = _random.integers(0, 1 << 63, size=(CHUNKS, len(VARIANTS)), dtype=np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """The values (chunks, places) of a set that is not empty. The bits taken are the highest, which multiplying mixes best."""
    return (near_copies.signature(found, MASKS, MULTIPLIERS) >> np.uint64(64 - BITS)).reshape(CHUNKS, CHUNK)


def keys(found: np.ndarray) -> list[int]:
    """A signed long for each variant of each chunk of the set's signature; none of an empty set."""
    if not len(found):
        return []
    part = signature(found) * WEIGHTS
    out = (part[:, None, :] * VARIANTS).sum(axis=2, dtype=np.uint64) + SALTS
    out = (out ^ out >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return out.ravel().view(np.int64).tolist()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text): the size of its set of WIDTH-word
    shingles, the smallest doc_id that chains of links of near_copies.SIMILARITY or more reach, and whether that is its own.

    A null or blank text has an empty set and no link. Rows without an id are not compared: their component is null and they
    are kept. Rows of one id are documents of their own, repeated rows repeat. Extra columns are ignored, an empty
    table gives an empty result."""
    common.small_text_batches(docs.sparkSession)
    docs = near_copies.keyed(docs).select("doc_id", "text", "digest")
    texts = common.stored(near_copies.signed_texts(docs, WIDTH, keys), "signed")
    full = texts.where("doc_id is not null and size > 0")
    nodes = common.stored(full.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    found = near_copies.links(docs.where("doc_id is not null"), nodes, WIDTH, PIVOTS)
    roots = common.stored(simhash.components(common.stored(found, "links")), "roots")
    with_root = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    smallest = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.stored(with_root.join(smallest, "root").select("node", "component_id"), "named")
    linked = common.joined(full.select("doc_id", "size", "node"), named, "node").select("doc_id", "size", "component_id")
    alone = texts.where("doc_id is null or size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
