"""Repeated passages of 51 to 60 words, wherever they stand."""

from __future__ import annotations

import random

from quern.llm import substring_dedup


def left(spark, texts):
    out = substring_dedup.substring_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {r.doc_id: r.text for r in out.collect()}


def test_parts_equal_plain_ones(spark):
    import pyarrow as pa
    from test_operators import plain_parts

    rng = random.Random(1)
    texts = ["", None, " \n ", "One. Two! three\n\nfour", "x" * 3000, "é ñ. Ü\u00a0b?"]
    texts += [" ".join(rng.choice(["a", "B.", "cc", "dd!", "e\nf", "g"]) * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for first, raw, cut in substring_dedup.cuts(pa.array(texts)):
        for t in range(len(cut.offsets) - 1):
            span = range(cut.first_part[t], cut.first_part[t + 1])
            at = int(cut.offsets[t])
            mine = [(raw[at : cut.starts[cut.first[p]]].decode(), raw[at : cut.ends[cut.final[p]]].decode()) for p in span]
            text = texts[first + t] or ""
            assert mine == [(text[:a], text[:b]) for a, b, _ in plain_parts(text)]


def test_every_passage_of_51_words_loses_its_middle(spark):
    rng = random.Random(7)
    word = lambda mark=0.0: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) + ("." if rng.random() < mark else "")
    texts, middles = [], []
    for k in range(300):
        passage = [word((0, 0.02, 0.12, 0.3)[k % 4]) for _ in range(51 + k % 10)]
        for gap in (" ", ("\t", "  ", " ")[k % 3]):
            host = [word(0.1) for _ in range(80)]
            texts.append(" ".join(host[:40]) + gap + gap.join(passage) + gap + " ".join(host[40:]))
        middles.append(passage)
    found = left(spark, texts)
    for k, passage in enumerate(middles):
        assert 2 * k not in found
        assert len(set(found[2 * k + 1].split()) & set(passage)) < len(passage) / 2


def test_runs_of_one_word_keep_their_first_occurrence(spark):
    host = " ".join(f"word{i}" for i in range(30))
    found = left(spark, [f"{host} {'is ' * 60}", f"other {'is ' * 55}", "Re " * 51])
    assert set(found) == {0, 1, 2}
    assert substring_dedup.SPAN_WORDS <= found[0].split().count("is") < 40
    assert found[1].split().count("is") < 20
    assert found[2].split().count("Re") == substring_dedup.SPAN_WORDS
