"""Vector codes, MinHash near duplicates and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import empty, odd
from oracle import connect, differences
from test_near_copies import edited
from test_operators import low

from quern.llm import minhash, near_copies, queries, spellings, vector_codes


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_minhash", "op13_spellings"])
def test_equals_sql(spark, sf_dir, tmp_path, name):
    found = differences(connect(sf_dir), queries.queries()[name](spark, sf_dir), queries.oracle_sql()[name], str(tmp_path / name))
    assert found[0] == found[1] and found[2] == 0 and not found[3]


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows (vec_id, label, vector): every part against every entry."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    d = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * d : (p + 1) * d]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    books = [[cut(v, p) for _, _, v in sorted(kept, key=lambda r: (r[0] is None, r[0]))[:entries]] for p in range(parts)]
    nearest = lambda v, p: min(range(len(books[p])), key=lambda e: (apart(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        groups = [[[] for _ in b] for b in books]
        for _, _, v in kept:
            for p in range(parts):
                groups[p][nearest(v, p)].append(cut(v, p))
        books = [[[sum(c) // len(g) for c in zip(*g, strict=True)] if g else old for g, old in zip(groups[p], books[p], strict=True)] for p in range(parts)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, lab, v in kept:
        code = [nearest(v, p) for p in range(parts)]
        out.append((i, lab, "".join(f"{e:02x}" for e in code), sum(apart(cut(v, p), books[p][e]) for p, e in enumerate(code))))
    total = {}
    for _, lab, _, error in out:
        total[lab] = total.get(lab, 0) + error
    return sorted((i, code, error, total[lab], digest) for i, lab, code, error in out)


def coded(spark, rows, **options):
    table = spark.createDataFrame([(i, lab, v, 1, "x") for i, lab, v in rows], "vec_id long, label int, embedding array<double>, error int, code string")
    return sorted(tuple(r) for r in vector_codes.encode(table, **options).collect())


def test_codes_equal_plain_assignment(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "CHUNK_BYTES", 16 * 8 * 100)  # several trees
    rng = random.Random(3)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(5)]
    rows = [(k, rng.choice([None, 0, 0, 0, 1]), [c + rng.gauss(0, 0.02) for c in rng.choice(centres)]) for k in range(400)]
    rows += [(1000 + k, 2, [0.25, -0.25] * 8) for k in range(40)]  # equal vectors
    rows += [(-1, 0, None), (-2, 0, [None] + [0.0] * 15), (-3, 0, [math.nan] * 16), (-4, 1, [math.inf] + [0.0] * 15)]
    assert coded(spark, rows) == plain_codes(rows)


def test_few_vectors_and_odd_ones(spark):
    rows = [(2, None, [0.5] * 8), (1, None, [-0.5] * 8), (3, 7, [0.5] * 8)]
    assert coded(spark, rows) == plain_codes(rows)
    assert coded(spark, []) == []
    assert coded(spark, [(1, 1, None)]) == []
    # other lengths than the first's, and those that eight does not divide, are left out
    assert [r[0] for r in coded(spark, [(0, 1, [1.0] * 7), (1, 1, [1.0] * 8), (2, 1, [1.0] * 16), (3, 1, [])])] == [1]
    with pytest.raises(Exception, match="a component beyond"):
        coded(spark, [(1, 1, [1e300] * 8)])


def test_boxes_hand_over_whole_subtrees():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (8, 4))
    points = centres[rng.integers(0, 8, 3000)] + rng.integers(-20, 20, (3000, 4))
    tree = vector_codes.build(points)
    steps = list(vector_codes.walk(tree, centres))
    looked_at = sum(len(at) for level, at, _, _ in steps if level < 0)
    assert looked_at < len(points) // 4
    for book in (centres, rng.integers(-4000, 4000, (16, 4)), np.repeat(centres[:2], 3, axis=0)):
        apart = ((points[:, None] - book) ** 2).sum(axis=2)
        entries, found = vector_codes.assigned(tree, book)
        assert (entries == apart.argmin(axis=1)).all() and (found == apart.min(axis=1)).all()
        sums, counts = np.zeros_like(book), np.zeros(len(book), dtype=np.int64)
        vector_codes.moved(tree, book, sums, counts)
        assert (counts == np.bincount(apart.argmin(axis=1), minlength=len(book))).all()
        assert sums.sum() == points.sum()


# MinHash


def plain_components(table, width=4):
    sets = []
    for i, text in table:
        words = re.findall(r"[^\x20\x09-\x0D]+", low(text or ""))
        sets.append((i, {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for b, (j, t) in enumerate(sets[:a]):
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return sorted(((i, len(s), least.get(find(a)), i == least.get(find(a))) for a, (i, s) in enumerate(sets)), key=str)


def found_components(spark, table):
    out = minhash.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_links_equal_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    table = []
    for k in range(100):  # both sides of the bound
        words = [word() for _ in range(120)]
        table += [(2 * k, " ".join(words)), (2 * k + 1, edited(rng, words, 1 + k % 4))]
    words = [word() for _ in range(200)]
    table += [(1000 + k, edited(rng, words, 2)) for k in range(60)]  # beyond ALL_PAIRS
    table += [(2000, "One two three"), (2001, "one TWO\x0bthree"), (2002, "one two"), (2003, ""), (2004, None), (2005, " \n"), (2003, ""), (3000, " ".join(words[:180])), (3000, table[0][1])]
    assert found_components(spark, table) == plain_components(table)


def test_hub_of_a_large_group_is_found(spark):
    """A text near to many that are not near to each other."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    shared = [word() for _ in range(250)]
    table = [(k, " ".join(shared + [word() for _ in range(41)])) for k in range(80)]
    assert all(r[3] for r in plain_components(table))
    table.append((500, " ".join(shared)))
    assert found_components(spark, table) == plain_components(table)


def test_signatures_within_the_distance_share_a_key(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(0, 1 << minhash.BITS, (minhash.CHUNKS, minhash.CHUNK), dtype=np.uint64)
        b = a.copy()
        b.ravel()[rng.choice(a.size, minhash.DISTANCE, replace=False)] ^= np.uint64(1)
        got = []
        for x in (a, b):
            monkeypatch.setattr(minhash, "signature", lambda _, x=x: x)
            got.append(set(minhash.keys(np.ones(1))))
        assert got[0] & got[1]


def test_minhash_takes_odd_rows(spark):
    out = minhash.near_duplicates(odd(spark)).collect()
    assert len(out) == odd(spark).count()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id in (1, 2, 3, None)} == {(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (None, 1, None, True), (None, 0, None, True)}
    assert minhash.near_duplicates(empty(spark)).count() == 0


# Spelling variants


def plain_vocabulary(table):
    counts = {}
    for i, text in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] = counts.get(word, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spellings(table):
    words = plain_vocabulary(table)
    near = {w: sorted((x for x in words if plain_near(w, x)), key=lambda x: (-words[x], x)) for w in words}
    form = {w: x[0] if (x := near[w]) and words[x[0]] >= 5 * words[w] else None for w in words}
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def variants(rng, words, times):
    out = []
    for w in words:
        for _ in range(times):
            i, c = rng.randrange(len(w)), rng.choice("abéx")
            out.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w]))
    return out


def spelled(spark, table):
    out = spellings.group_spellings(spark.createDataFrame(table, "doc_id long, text string"))
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("small", [False, True])
def test_spellings_equal_brute_force(spark, monkeypatch, small):
    if small:  # blocks of a cell, and batches that end within one
        for name, value in (("CELL_WORDS", 3), ("ROWS_AT_ONCE", 20), ("MET_AT_ONCE", 10)):
            monkeypatch.setattr(spellings, name, value)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    rng = random.Random(5)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 10))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "abababab", "ababababa"]
    near = variants(rng, base, 6)
    table = [(k, " ".join(rng.choice(base) for _ in range(60)) + ", " + "-".join(rng.choice(near) for _ in range(40)).upper()) for k in range(60)]
    table += [(None, "Zebrafinch zebrafinch. " * 9), (1, None), (2, ""), (3, "x" * 50_000), (4, "Zebrafinc " * 5 + "zebrafin " * 5), (5, "Zebrafinch " * 40)]
    try:
        expected = plain_spellings(table)
        assert sum(r[4] for r in expected) > 50 and any(r[1] for r in expected)
        assert spelled(spark, table) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def test_lost_letters_and_chains_of_forms(spark):
    """Ids chosen so that a run loses a letter; and forms that lead on."""
    word = "spelling"
    lost = [i for i in range(3000) if zlib.crc32(f"{i}:{word}".encode()) % 199 == 0]
    table = [(i, word.title()) for i in lost] + [(k, "Chainword " * 130 + "chainwor " * 26 + "chainwo " * 5) for k in range(1)]
    expected = plain_spellings(table)
    assert spelled(spark, table) == expected
    assert ("chainwo", "chainwor", "chainword", 5, 1, 26) in expected


def test_spellings_take_odd_rows(spark):
    assert spellings.group_spellings(empty(spark)).count() == 0
    assert spellings.vocabulary(odd(spark)).count() == len(plain_vocabulary([(r.doc_id, r.text) for r in odd(spark).collect()]))


def test_counting_words_stays_in_the_jvm(spark, sf_dir):
    text = spellings.vocabulary(queries.table(spark, sf_dir, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange") == 1
    assert near_copies.SIMILARITY == 0.8
