"""Every catalogue query against its SQL, and the shape of the plans."""

from __future__ import annotations

import datetime
import hashlib
import re
from difflib import SequenceMatcher
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from oracle import connect, differences

from quern.operators import models
from quern.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(request):
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, sf_dir, tmp_path, name):
    mine, theirs, rows, kinds = differences(con, QUERIES[name](spark, sf_dir), ORACLES[name], str(tmp_path / name))
    assert mine == theirs
    assert rows == 0
    assert not kinds


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


PYTHON = {"path_digests", "text_similarity", "fuzzy_distinct", "greedy_packing", "token_bucket", "page_links", "key_rotation", "fuzzy_turns", "fuzzy_first_match", "latency_log", "model_answers", "batch_answers", "sentence_vectors", "translated_pages", "cooled_bucket"}


def test_path_digests(spark, sf_dir):
    rows = QUERIES["path_digests"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), "page_id").collect()
    assert rows and all(r.digest == hashlib.blake2b(r.url.encode(), digest_size=8).hexdigest() for r in rows)


def test_text_similarity(spark, sf_dir):
    texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()}
    out = {(r.conv_id, r.turn): r.ratio for r in QUERIES["text_similarity"](spark, sf_dir).collect()}
    assert out == {(c, k): round(SequenceMatcher(None, x, texts[c, k + 1]).ratio(), 9) for (c, k), x in texts.items() if (c, k + 1) in texts}


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def test_fuzzy_distinct_of_documents_equals_the_plain_loop(spark, sf_dir):
    groups = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        groups.setdefault((r.source, r.lang), []).append(r)
    wanted = set()
    for key, rows in groups.items():
        kept = {}
        for r in rows:
            if r.text in kept.values() or any(ratio(r.text, k) >= 0.85 for k in kept.values()):
                continue
            kept[r.doc_id] = r.text
        wanted |= {(*key, i) for i in kept}
    out = QUERIES["fuzzy_distinct"](spark, sf_dir).collect()
    assert {(r.source, r.lang, r.doc_id) for r in out} == wanted and len(out) == len(wanted)


def test_first_match_equals_the_plain_loop(spark, sf_dir):
    parts = [(r.p_partkey, r.p_name, r.p_size) for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect()]
    ordered = sorted(parts, key=lambda p: (-p[2], p[0]))
    first = {}
    for name in {p[1] for p in parts}:
        first[name] = next((k, round(ratio(name, x), 9)) for k, x, _ in ordered if name in x or x in name or ratio(name, x) >= 0.65)
    assert {(r.p_partkey, r.first_partkey, r.ratio) for r in QUERIES["fuzzy_first_match"](spark, sf_dir).collect()} == {(k, *first[name]) for k, name, _ in parts}


def test_links_have_whole_addresses(spark, sf_dir):
    rows = QUERIES["page_links"](spark, sf_dir).collect()
    assert all("://" in r.url for r in rows if r.place == "anchor")
    assert len({(r.page_id, r.url) for r in rows}) == len(rows)


class Anchors(HTMLParser):
    """Hrefs of anchors with their text, in the order of their start."""

    def __init__(self):
        super().__init__()
        self.rows, self.open = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href"):
            self.rows.append([dict(attrs)["href"], ""])
            self.open.append(self.rows[-1])

    def handle_data(self, data):
        for row in self.open:
            row[1] += data

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.open.pop()


def test_anchors_equal_a_plain_parser(spark, sf_dir):
    wanted = set()
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        parser, seen = Anchors(), set()
        parser.feed(r.html)
        for href, text in parser.rows:
            if (full := urljoin(r.url, href)) not in seen:
                seen.add(full)
                wanted.add((r.page_id, href, full, text.strip()))
    found = {(r.page_id, r.href, r.url, r.anchor_text) for r in QUERIES["page_links"](spark, sf_dir).where("place = 'anchor'").collect()}
    assert found == wanted and wanted


def test_rotation_equals_a_plain_loop(spark, sf_dir):
    events = sorted(spark.read.parquet(f"{sf_dir}/events.parquet").collect(), key=lambda r: (r.event_type, r.ts, r.event_id))
    state, expected = {}, {}
    for r in events:
        now = (r.ts - datetime.datetime(1970, 1, 1)).total_seconds()
        at, keys = state.setdefault(r.event_type, [0, {}])
        label = None
        for step in range(3):
            name = "abc"[(at + step) % 3]
            tokens, last, day, used = keys.get(name, (5.0, now, None, 0))
            used = used if day == int(now // 86400) else 0
            if used < 20:
                tokens = min(5.0, tokens + (now - last) / 4)
                last = now
                if tokens >= 1:
                    tokens, used, label = tokens - 1, used + 1, name
            keys[name] = (tokens, last, int(now // 86400), used)
            state[r.event_type][0] = at + step + 1
            if label:
                break
        expected[r.event_id] = label
    assert {r.event_id: r.label for r in QUERIES["key_rotation"](spark, sf_dir).collect()} == expected


def turns(spark, sf_dir):
    return sorted((r.conv_id, r.turn, r.text) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect())


def test_model_answers_equal_the_plain_loop(spark, sf_dir):
    budget = lambda n: 1200 if n < 2000 else 2500 if n < 6000 else 4000
    wanted = {(c, k): models.echo_client(x, budget(len(x))) or None for c, k, x in turns(spark, sf_dir)}
    rows = QUERIES["model_answers"](spark, sf_dir).collect()
    assert {(r.conv_id, r.turn): r.response for r in rows} == wanted
    assert all((r.error is None) == (r.response is not None) for r in rows)


def test_batch_answers_equal_the_plain_loop(spark, sf_dir):
    batches, wanted = {}, {}
    for c, k, x in turns(spark, sf_dir):
        batches.setdefault(c, {})[f"turn{k}.txt"] = x
    for c, files in batches.items():
        names = sorted(files)
        failed = len(names) > 2 and len(names) % 2 == 0
        for i, name in enumerate(names):
            alone = failed or (len(names) > 1 and i == len(names) - 1)
            wanted[c, name] = (f"{len(files[name].strip())} characters", alone)
    rows = QUERIES["batch_answers"](spark, sf_dir).collect()
    assert {(r.batch, r.file): (r.response, r.asked_alone) for r in rows} == wanted
    assert {r.asked_alone for r in rows} == {True, False} and not any(r.error for r in rows)


def test_sentence_vectors_equal_the_plain_loop(spark, sf_dir):
    wanted = {}
    for c, k, x in turns(spark, sf_dir):
        v = [0.0] * 64
        for word in x.lower().split():
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            v[h % 64] += 1.0 if h >> 63 else -1.0
        wanted[c, k] = v
    assert {(r.conv_id, r.turn): list(r.vector) for r in QUERIES["sentence_vectors"](spark, sf_dir).collect()} == wanted


def test_translated_lines_equal_the_plain_loop(spark, sf_dir):
    digits, vowels = str.maketrans("0123456789", "०१२३४५६७८९"), str.maketrans("aeiou", "अएइओउ")
    wanted = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for k, line in enumerate(r.text.split("\n")):
            written = line.translate(digits).translate(vowels) if k % 2 == 0 else line.translate(digits)
            share = sum("ऀ" <= ch <= "ॿ" for ch in written) / len(written) if written else 0
            wanted[r.doc_id, k] = line if k % 2 or share >= 0.2 else written.translate(str.maketrans("०१२३४५६७८९", "0123456789"))
    found = {(r.doc_id, r.line_no): r.line for r in QUERIES["translated_pages"](spark, sf_dir).collect()}
    assert found == wanted and len({k for (_, k), x in wanted.items()}) > 1


OUTSIDE = "EvalPython|MapInPandas|MapInArrow|PythonMapIn|InPandas|InArrow|CartesianProduct|NestedLoop"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON))
def test_stays_in_the_jvm(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    # operators, not words: a message's text may name Python
    assert not re.search(OUTSIDE, text)


#: Their Python ran when they were called: the last step reads stored tables.
STORED = {"fuzzy_distinct", "fuzzy_turns"}


@pytest.mark.parametrize("name", sorted(PYTHON - STORED))
def test_the_others_are_told_apart(spark, sf_dir, name):
    assert re.search(OUTSIDE, plan(QUERIES[name](spark, sf_dir)))


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["route_by_size"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text
    assert "PushedFilters: [IsNotNull(p_size), GreaterThan(p_size,10)" in plan(QUERIES["attach_profile"](spark, sf_dir))


def test_matching_shuffles_nothing_before_its_order(spark, sf_dir):
    assert "Exchange" not in plan(QUERIES["match_debug_map"](spark, sf_dir))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
