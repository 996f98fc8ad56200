"""The merge index over several flushes."""

from __future__ import annotations

from collections import Counter

import pytest
from fixtures import odd
from pyspark.sql import functions as F

from quern.llm import common, exact_dedup


@pytest.mark.parametrize(("flushes", "digest_bytes"), [(2, 32), (7, 32), (3, 1)])
def test_later_flushes_merge_with_earlier_levels(spark, sf_dir, flushes, digest_bytes):
    docs = common.stored(common.table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text")), "docs")
    index = exact_dedup.Index(digest_bytes)
    for k in range(flushes):
        index.flush(docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(flushes)) == k))
        index.compact()
        assert len(index.levels) <= exact_dedup.FANOUT
    rows = lambda df: Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())
    out = index.resolve(docs)
    assert rows(out) == rows(exact_dedup.exact_dedup(docs))
    assert out.where("kept").select("text_sha256").distinct().count() == out.where("kept").count()


def test_levels_are_in_order(spark, sf_dir):
    index = exact_dedup.Index()
    index.flush(common.table(spark, sf_dir, "documents").repartition(4))
    index.compact()
    level = index.levels[0][0]
    parts = level.select(F.spark_partition_id().alias("p"), "digest").collect()
    by_part: dict[int, list[bytes]] = {}
    for r in parts:
        by_part.setdefault(r.p, []).append(bytes(r.digest))
    assert all(d == sorted(set(d)) for d in by_part.values())
