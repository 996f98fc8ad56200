"""The pipeline's near-duplicate stage against brute force on five-word Jaccard similarity."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from fixtures import odd
from test_operators import low

from quern.llm import common, decontaminate, near_copies, simhash


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(table):
    """The smallest id of each group that chains of pairs of 0.8 or more join."""
    sets = [(i, plain_set(t)) for i, t in sorted(table)]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if (len(a & b) >= 0.8 * len(a | b)) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {find(i) for i in root}


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_stage_removes_what_brute_force_removes(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = common.stored(stage(spark, docs, sf_dir), "before")
    before = {r.doc_id: r.text for r in docs.collect()}
    near = common.stored(corpus_pipeline.near(spark, docs, sf_dir), "near")
    kept = {r.doc_id for r in near.collect()}
    assert kept == plain_kept(before.items())
    assert len(kept) < len(before)
    items = [decontaminate.normalised(r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    clean = {i for i in kept if not any(x in decontaminate.normalised(before[i]) for x in items)}
    assert {r.doc_id for r in corpus_pipeline.leaks(spark, near, sf_dir).collect()} == clean


def test_planted_near_copies_and_large_groups(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    table = []
    for k in range(120):  # pairs on both sides of the bound
        words = [word() for _ in range(200)]
        table += [(2 * k, " ".join(words)), (2 * k + 1, edited(rng, words, 1 + k % 6))]
    words = [word() for _ in range(300)]
    table += [(1000 + k, edited(rng, words, 3)) for k in range(100)]  # beyond ALL_PAIRS
    table += [(2000, " ".join(words[:250])), (2001, ""), (2002, None), (2003, " \n"), (2004, "One two"), (2005, "one  TWO")]
    out = near_copies.without_near_copies(spark.createDataFrame(table, "doc_id long, text string"))
    assert {r.doc_id for r in out.collect()} == plain_kept(table)


def test_large_buckets_lose_no_pair(spark, monkeypatch):
    """A text that is near to a hundred others, which are not near to each other: few of them are its buckets' pivots."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    shared = [word() for _ in range(250)]
    table = [(k, " ".join(shared + [word() for _ in range(41)])) for k in range(100)]
    assert plain_kept(table) == set(range(100))
    table.append((500, " ".join(shared)))
    assert plain_kept(table) == {0}
    docs = spark.createDataFrame(table, "doc_id long, text string")
    assert [r.doc_id for r in near_copies.without_near_copies(docs).collect()] == [0]
    monkeypatch.setattr(near_copies, "unsettled", lambda large, roots, sets: roots.select("node", "root").toDF("a", "b").limit(0))
    assert near_copies.without_near_copies(docs).count() > 1  # pivots alone do not find them all


def test_odd_rows(spark):
    out = near_copies.without_near_copies(odd(spark))
    assert out.columns == odd(spark).columns
    assert out.where("doc_id is null").count() == 2
    assert out.where("doc_id in (3, 4, 5)").count() == 1


def test_the_trie_self_join_links_near_copies_by_itself(spark, monkeypatch):
    """With no pair proposed by bands, pairs within the trie's budget are still found, and those alone."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    table, near = [], 0
    for k in range(60):
        words = [word() for _ in range(300)]
        pair = [" ".join(words), edited(rng, words, 1 + k % 8)]
        table += [(2 * k, pair[0]), (2 * k + 1, pair[1])]
        sets = [near_copies.shingles(t) for t in pair]
        bits = (simhash.fingerprint(sets[0]) ^ simhash.fingerprint(sets[1])).bit_count()
        near += bits <= near_copies.TRIE_BUDGET and near_copies.similarity(*sets) >= near_copies.SIMILARITY
    assert 20 < near < 60
    table += [(1000, ""), (1001, None), (1002, "one"), (1003, "ONE")]
    none = lambda nodes, pivots: (nodes.selectExpr("node a", "node b").limit(0), nodes.selectExpr("node bucket", "node").limit(0))
    monkeypatch.setattr(near_copies, "proposed", none)
    out = near_copies.without_near_copies(spark.createDataFrame(table, "doc_id long, text string"))
    assert out.count() == len(table) - near - 2
