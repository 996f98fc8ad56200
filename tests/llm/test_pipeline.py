"""The pipeline's stages: each on all that its predecessor kept, and their decisions against brute force."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from fixtures import empty, odd
from test_near_copies import plain_kept
from test_operators import low

from quern.llm import common, decontaminate

NAMES = ["language", "exact", "near", "decontaminate", "pack"]


def test_stages_filter_and_pack(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = common.table(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns
        assert docs.exceptAll(before).count() == 0
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    largest = {low(t): i for i, t in sorted(kept["language"].items())}
    assert kept["exact"] == {i: kept["language"][i] for i in largest.values()}
    assert set(kept["near"]) == plain_kept(kept["exact"].items())
    items = [decontaminate.normalised(r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    clean = {i for i, t in kept["near"].items() if not any(x in decontaminate.normalised(t) for x in items)}
    assert set(kept["decontaminate"]) == clean
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.collect()} == clean
    whole = corpus_pipeline.run(spark, sf_dir)
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed.collect())


def test_stages_take_odd_rows_and_empty_tables(spark, sf_dir):
    for table in (odd(spark), empty(spark)):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = common.stored(stage(spark, docs, sf_dir), name)
        assert docs.count() >= 0
