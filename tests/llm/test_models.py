"""What the small trained models are worth on rows that they were not taught."""

from __future__ import annotations

import numpy as np
import zstandard
from fixtures import odd_rows
from test_operators import plain_url, rows

from quern.llm import common, langid, pii, queries, url_filter


def test_url_model_on_held_out_host_words():
    chosen = url_filter.words()
    assert not {"spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track"} & {w for w, _ in chosen}
    table = lambda part: sorted((*plain_url(u), y) for u, y in url_filter.labelled_rows(part))
    model = url_filter.train(table([w for w in chosen if not url_filter.held_out(w[0])]))
    unseen = table([w for w in chosen if url_filter.held_out(w[0])])
    said = [url_filter.probability(h, p, *model) > url_filter.THRESHOLD for h, p, _ in unseen]
    right = sum(s and y for s, (*_, y) in zip(said, unseen, strict=True))
    assert right / sum(said) > 0.8
    assert right / sum(y for *_, y in unseen) > 0.5


#: (text, what is found beside the base kinds), by hand.
BY_HAND = [
    ("You can write to maria.k (at) posteo (dot) de any time.", ["email"]),
    ("We met at noon. Then she left.", []),
    ("He was at home.\nIt rained. Nobody called.", []),
    ('password = "5f4dcc3b5aa765d61d8327deb882cf99"', ["secret"]),
    ("see /how-to-write-a-letter-that-people-read today", []),
    ("Phone: (212) 555-0187 after six", ["phone"]),
    ("pages 1234-1299 of volume 77", []),
    ("1234567812345678 8765432187654321", []),
    ("device 00:1a:2b:3c:4d:5e joined", ["device"]),
    ("-" * 60, []),
    ("token: " + "a1B2" * 50, ["secret"]),
]


def test_added_spans_by_hand():
    trees, cut = pii.model()
    found = [[k for k, *_ in pii.added_spans(t, pii.base_spans(t), trees, cut)] for t, _ in BY_HAND]
    assert sum(f == e for f, (_, e) in zip(found, BY_HAND, strict=True)) >= len(BY_HAND) - 1
    assert all(f == [] for f, (_, e) in zip(found, BY_HAND, strict=True) if not e)


def test_added_spans_on_documents(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    said = {r["doc_id"]: [s.split(":") for s in r["spans"].split(",") if s] for r in rows(pii.find(docs))}
    secrets = [(i, int(a), int(b)) for i, spans in said.items() for k, a, b in spans if k == "secret"]
    planted = sum(t.lower().count('token = "') for t in texts.values())
    assert len(secrets) == planted > 0
    assert all(texts[i][:a].lower().endswith('token = "') for i, a, b in secrets)
    added = sum(len(spans) for spans in said.values()) - sum(len(pii.base_spans(t)) for t in texts.values())
    assert added <= len(secrets) * 1.05 + 1


def test_overlaps_equal_plain_ones():
    rng = np.random.default_rng(4)
    for _ in range(200):
        spans = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, 8), rng.integers(1, 9, 8), strict=True)]
        taken = pii.Taken(spans)
        for a in range(60):
            assert taken.overlaps(a, a + 3) == any(x < a + 3 and a < y for x, y in spans)


def test_language_sizes_equal_a_plain_loop(spark, sf_dir):
    model = langid.fit(queries.taught(common.table(spark, sf_dir, "documents")))
    assert all(len(d) <= langid.DICTIONARY_BYTES for d in model.values())
    texts = [r.text for r in common.table(spark, sf_dir, "documents").limit(40).collect()] + [t for _, t, *_ in odd_rows() if t][:5]
    mine = langid.Compressors(model)
    for text in texts:
        letters = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" "))
        raw = langid.prepared(text)
        assert letters.split() == raw.decode().split()
        for lang, size in zip(mine.languages, mine.sizes(text), strict=True):
            total = 0
            for i in range(0, len(raw), langid.PIECE_BYTES):
                known = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packed = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=known, write_content_size=False).compress(raw[i : i + langid.PIECE_BYTES])
                assert zstandard.ZstdDecompressor(dict_data=known).decompress(packed, max_output_size=1 << 20) == raw[i : i + langid.PIECE_BYTES]
                total += len(packed)
            assert total == size
