"""Stages on rows that share an id, have none, or repeat."""

from __future__ import annotations

from collections import Counter

from quern.llm import decontaminate, exact_dedup, near_copies

A = " ".join(f"word{k}" for k in range(60))
B = " ".join(f"other{k}" for k in range(60))


def kept(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_copies_on_repeated_ids(spark):
    assert kept(near_copies.without_near_copies(table(spark, [(1, A), (10, A), (10, B)]))) == Counter([(1, A), (10, B)])
    assert kept(near_copies.without_near_copies(table(spark, [(1, A), (1, A), (1, A + " end"), (2, A)]))).total() == 1
    out = kept(near_copies.without_near_copies(table(spark, [(5, A), (5, A), (None, A), (None, A), (5, B), (5, B)])))
    assert out == Counter({(5, A): 1, (5, B): 1, (None, A): 2})


def test_leaks_on_repeated_and_missing_ids(spark):
    benchmark = spark.createDataFrame([(1, A)], "item_id long, text string")
    assert kept(decontaminate.without_leaks(table(spark, [(10, A), (10, B), (None, A), (None, B), (10, B)]), benchmark)) == Counter({(10, B): 2, (None, B): 1})
    two = spark.createDataFrame([(1, A), (2, B)], "item_id long, text string")
    assert kept(decontaminate.without_leaks(table(spark, [(1, A), (2, B), (3, "x"), (4, None)]), two, item_bytes_a_pass=300)) == Counter([(3, "x"), (4, None)])


def test_exact_copies_on_repeated_ids(spark):
    assert kept(exact_dedup.without_copies(table(spark, [(1, A), (10, A), (10, B), (10, A), (None, B)]))) == Counter([(10, A), (10, B)])
