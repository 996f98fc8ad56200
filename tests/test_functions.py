"""Functions and operators on small inline frames; expected values follow from their definitions."""

from __future__ import annotations

import datetime as dt
import difflib
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import dates, records
from quern.functions import text as T
from quern.functions import vectors as V
from quern.operators import dedup, extract, match, models, ratelimit, state, windows
from quern.plans import stages
from quern.plans.catalogue import QUERIES
from quern.sources import files


def one(spark, expression, **values):
    names = list(values) or ["x"]
    return spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{k} string" for k in names)).select(expression.alias("v")).first().v


C = F.col


@pytest.mark.parametrize("text", ["a b", "  ", "", "\t a\x1cb\x85c d　 e\n", "x", None])
def test_words_are_those_of_python(spark, text):
    assert one(spark, T.words(C("x")), x=text) == (text or "").split()
    if text is not None:
        assert one(spark, T.strip(C("x")), x=text) == text.strip()


def test_keywords(spark):
    assert one(spark, T.keyword_score(C("x")), x="Posts") == 2
    assert one(spark, T.has_keywords(C("x")), x="POSTS open") is True
    assert one(spark, T.has_keywords(C("x")), x="salary") is False
    assert one(spark, T.has_keywords(C("x"), force=True), x="") is True
    assert one(spark, T.keyword_score(C("x")), x=None) == 0


def test_scripts(spark):
    assert one(spark, T.is_script(C("x")), x="नabcd") is True
    assert one(spark, T.is_script(C("x")), x="नabcde") is False
    assert one(spark, T.is_script(C("x")), x="") is False
    assert one(spark, T.is_gibberish(C("x")), x="") is True
    assert one(spark, T.is_gibberish(C("x")), x="%%%% a") is True
    assert one(spark, T.is_gibberish(C("x")), x="plain words") is False
    assert one(spark, T.ascii_digits(C("x")), x="२०२५ a") == "2025 a"


def test_strings(spark):
    assert one(spark, T.lstrip_set(C("x"), "📌 "), x="📌 📌a📌") == "a📌"
    assert one(spark, T.clean_ocr(C("x")), x=" a\f \t b\n\n\n\nc � ") == "a b\n\nc"
    assert one(spark, T.clean_lines(C("x")), x=" a \n\n  \n b") == "a\nb"
    assert one(spark, T.collapse_blank_lines(C("x")), x="a\n \n b") == "a\n\n b"
    assert one(spark, T.normalise_name(C("x")), x="The-Hindu_(12/05) 2024.pdf") == "the hindu pdf"
    assert one(spark, T.clean_name(C("x")), x="Indian Express") == "indian ie"
    assert one(spark, T.name_contains(C("a"), C("b")), a="", b="x") is True
    assert one(spark, T.safe_file_name(C("x")), x=" a b/c?.pdf ") == "a_b_c_.pdf"
    assert one(spark, T.safe_file_name(C("x")), x="") == "file"
    assert one(spark, T.escape_html(C("x")), x="<a & 'b\">") == "&lt;a &amp; &#x27;b&quot;&gt;"
    assert one(spark, T.escape_code(C("x")), x="a-b.(c)") == "a&#45;b&#46;&#40;c&#41;"
    assert one(spark, T.preview(C("x"), 3), x="abcd") == "abc..."
    assert one(spark, T.page_number(C("x")), x="The_pioneer_p12_text.txt") == "12"
    assert one(spark, T.page_number(C("x")), x="none") == "0"
    assert one(spark, T.anchored_page_number(C("x")), x="a_p3_x.txt") == -1
    assert one(spark, T.issue_prefix(C("x")), x="The pioneer_p3_text.txt") == "The_pioneer"
    assert one(spark, T.issue_prefix(C("x"), legacy=True), x="The_pioneer_p3_text.txt") == "The"
    assert one(spark, T.title_languages(C("x")), x="Dainik Times") == ["hi", "en"]
    assert one(spark, T.title_languages(C("x")), x="Times") == ["en"]
    assert one(spark, T.fill_template("{a} {content}", "{content}", C("x")), x="z") == "{a} z"
    assert one(spark, T.without_fence(C("x")), x="```\n{}\n```") == "{}"
    assert one(spark, T.outer_braces(C("x")), x='a {"b": {}} c') == '{"b": {}}'
    assert one(spark, T.outer_braces(C("x")), x="no") is None


def test_records(spark):
    assert one(spark, records.deadline(C("x")), x="Apply by 12 July 2025") == "12 July 2025"
    assert one(spark, records.deadline(C("x")), x="by July 23, 2025") == "Not specified"
    assert one(spark, records.deadline(C("x"), extended=True), x="by July 23, 2025") == "July 23, 2025"
    assert one(spark, records.employer(C("x")), x="3. - Acme Ltd | clerk") == "Acme Ltd"
    assert one(spark, records.employer(C("x")), x="join the State Power Corporation now") == "join the State Power Corporation"
    assert one(spark, records.employer(C("x")), x="ab | c") == "Unknown Organization"
    assert one(spark, records.website(C("x")), x="see https://a.b/c d") == "https://a.b/c"
    assert one(spark, records.choose_profile(C("x")), x="send an email") == "aiml"
    assert one(spark, records.choose_profile(C("x"), whole_words=True), x="send an email") == "hybrid"
    assert one(spark, records.tip(C("x")), x="Team lead, python").startswith("Highlight teamwork")
    for text, loose, strict in (
        ("Recommended", True, True),
        ("Not recommended", False, False),
        ("Match Score: 4", True, True),
        ("match score: 3 ... not recommended", True, False),
        ("Verdict: Recommended", True, True),
        (None, False, False),
    ):
        assert one(spark, records.is_recommended(C("x")), x=text) is loose
        assert one(spark, records.is_recommended(C("x"), strict=True), x=text) is strict
    for text, shown, value in (("Match Score: 4/5", "4", 4.0), ("match score: **4**/5", "**4**", None), ("match score: 4", "N/A", None), ("Match score: 4d/5", "4d", None)):
        assert one(spark, records.score_text(C("x")), x=text) == shown
        assert one(spark, records.score_value(C("x")), x=text) == value
    assert one(spark, records.link_type(C("x")), x="https://drive.google.com/x") == "gdrive"
    assert one(spark, records.link_type(C("x")), x="a.PDF") == "direct_pdf"
    assert one(spark, records.link_type(C("x")), x="pdf/a") == "likely_pdf"
    assert one(spark, records.drive_id(C("x")), x="https://d/file/d/abcdefghijk/view") == "abcdefghijk"
    assert one(spark, records.resource_key(C("x")), x="https://d/?a=1&ResourceKey=0-x") == "0-x"
    assert one(spark, records.direct_pdf(C("x")), x="https://v/viewer?url=https%3A%2F%2Fa.b%2Fc%2Epdf") == "https://a.b/c.pdf"
    assert one(spark, records.direct_pdf(C("x")), x="nothing") is None
    assert one(spark, records.readable_size(F.lit(1024.0))) == "1024.00 B"
    assert one(spark, records.readable_size(F.lit(1536.0))) == "1.50 KB"
    assert one(spark, records.is_pdf(F.lit(b"%PDF" + b"x" * 50 + b"%%EOF"), 20)) is True
    assert one(spark, records.is_pdf(F.lit(b"<htm" + b"x" * 50 + b"%%EOF"), 20)) is False
    assert one(spark, records.dpi(F.lit(2500), F.lit(100), F.lit(280))) == 200
    assert one(spark, records.dpi(F.lit(500), F.lit(100), F.lit(72))) == 150


def test_dates(spark):
    day = F.lit(dt.date(2024, 12, 1))
    every = one(spark, dates.spellings(day))
    assert len(every) == len(set(every)) and every[0] == "01-12-2024" and "Dec 01" in every
    assert one(spark, dates.mentions_date(C("x"), day), x="issue of 1 December") is True
    assert one(spark, dates.mentions_date(C("x"), day), x="01.12.24") is True
    assert one(spark, dates.mentions_date(C("x"), day), x="11.12.24") is False
    assert one(spark, dates.iso_or_epoch(C("x")), x="garbage") == dt.datetime(1970, 1, 1)
    assert one(spark, dates.duration(F.lit(3723))) == "1h 2m 3s"
    assert one(spark, dates.next_daily(F.lit("2024-01-01 10:00:00").cast("timestamp"), 9, 30)) == dt.datetime(2024, 1, 2, 9, 30)


def test_vectors(spark):
    assert one(spark, V.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(0.5**0.5)
    assert one(spark, V.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) is None


@pytest.mark.parametrize("n", [0, 1, 999, 1000, 1001, 1900, 1901, 1950, 1951])
def test_word_windows(spark, n):
    words = [f"w{i}" for i in range(n)]
    out = windows.word_windows(spark.createDataFrame([(1, " ".join(words))], "id int, text string"), "text").orderBy("batch_no").collect()
    expected = [] if not n else [(0, words)] if n <= 1000 else [(s, words[s : s + 1000]) for s in range(0, n, 950)]
    assert [(r.word_start, r.text.split()) for r in out] == expected
    if n == 1950:
        short = windows.word_windows(spark.createDataFrame([(1, " ".join(words))], "id int, text string"), "text", drop_covered_tail=True)
        assert short.count() == len(expected) - 1


def test_pack_greedy(spark):
    sizes = [("a", 1, 1000), ("a", 2, 3600), ("a", 3, 2500), ("a", 4, 2500), ("a", 5, 10), ("a", 6, 3000), ("a", 7, 2001), ("b", 1, None), ("b", 2, 1)]
    out = windows.pack_greedy(spark.createDataFrame(sizes, "k string, pos int, n int"), ["k"], "pos", "n")
    assert {(r.k, r.pos): r.batch for r in out.collect()} == {("a", 1): 0, ("a", 2): 1, ("a", 3): 2, ("a", 4): 2, ("a", 5): 3, ("a", 6): 3, ("a", 7): 4, ("b", 1): 0, ("b", 2): 0}


def plain_fuzzy(rows, ratio):
    kept = []
    for text in rows:
        if not any(difflib.SequenceMatcher(None, text, k).ratio() >= ratio for k in kept):
            kept.append(text)
    return kept


def test_fuzzy_distinct_equals_the_plain_loop(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 40))) for _ in range(25)]
    rows = []
    for i in range(160):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("abcdefgh")
        rows.append((i % 3, i, "".join(text)))
    rows.append((0, 1000, "x" * 250 + "abc"))
    rows.append((0, 1001, "x" * 250 + "abd"))
    out = dedup.fuzzy_distinct(spark.createDataFrame(rows, "g int, pos int, t string"), ["g"], "pos", "t").orderBy("g", "pos").collect()
    for g in range(3):
        assert [r.t for r in out if r.g == g] == plain_fuzzy([t for k, _, t in rows if k == g], 0.85)


def test_token_bucket():
    b = ratelimit.Bucket(ratelimit.Limits())
    assert [b.ask(0.0) for _ in range(6)] == ["allowed"] * 5 + ["tokens"]
    assert b.ask(4.0) == "allowed"
    b = ratelimit.Bucket(ratelimit.Limits())
    assert [b.ask(10.0 * k) for k in range(21)] == ["allowed"] * 20 + ["quota"]
    assert b.ask(86400.0) == "allowed"
    b = ratelimit.Bucket(ratelimit.Limits())
    assert b.ask(0.0, throttled=True) == "allowed"
    assert (b.ask(59.0), b.ask(61.0)) == ("cooldown", "allowed")


def test_token_bucket_frame_equals_the_fold(spark):
    rng = random.Random(1)
    rows = [(k, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 200000))) for k in range(5) for i in range(60)]
    out = {(r.k, r.i): r.decision for r in ratelimit.token_bucket(spark.createDataFrame(rows, "k int, i int, ts timestamp"), "k", "ts", "i").collect()}
    for k in range(5):
        bucket = ratelimit.Bucket(ratelimit.Limits())
        for _, i, ts in sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1])):
            assert out[k, i] == bucket.ask(ts.replace(tzinfo=dt.UTC).timestamp())


RESPONSES = {
    1: ('{"files": [{"filename": "a.txt", "concise_listings": ["- x", "- - y"], "full_descriptions": []}]}', [("a.txt", "- x"), ("a.txt", "- y")]),
    2: ('```\n{"files": [{"filename": "b.txt", "concise_listings": ["z"]}]}\n```', [("b.txt", "- z")]),
    3: ('Sure! {"files": [{"concise_listings": ["- q"]}]} Done.', [("", "- q")]),
    4: ("{broken\nFILE: c.txt\n- one\n text\n - two\nFILE: d.txt\nFILE: e.txt\n- three", [("c.txt", "- one"), ("c.txt", "- two"), ("e.txt", "- three")]),
    5: ("garbage", []),
    6: ("", []),
    7: (None, []),
}


def test_listings(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in RESPONSES.items()], "id int, response string")
    out = extract.listings(df, "id", "response").orderBy("id", "filename", "line_no").collect()
    for k, (_, expected) in RESPONSES.items():
        assert [(r.filename, r.listing) for r in out if r.id == k] == expected


def test_responses_are_stripped_once_a_row(spark):
    """As one expression the plan held some hundreds of copies of each step."""
    df = spark.createDataFrame([(k, r) for k, (r, _) in RESPONSES.items()], "id int, response string")
    plan = extract.parsed(df, "response")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 2


def test_words_are_split_once_a_row(spark, sf_dir):
    plan = QUERIES["array_functions"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_links(spark):
    html = '<a href="/x">one</a><a data-u="https://d/e" href="y.pdf"><b>two</b></a><iframe src="//v/w"></iframe><script>var u="https://s/t.pdf";</script><a href="/x">again</a><a>no</a>'
    out = extract.links(spark.createDataFrame([(1, "http://h/p/q", html), (2, None, None)], "id int, url string, html string"), "id", "url", "html").orderBy("pos").collect()
    assert [(r.place, r.url, r.anchor_text) for r in out] == [("anchor", "http://h/x", "one"), ("anchor", "http://h/p/y.pdf", "two"), ("data", "https://d/e", ""), ("iframe", "http://v/w", ""), ("script", "https://s/t.pdf", "")]
    short = extract.anchors(spark.createDataFrame([(1, html)], "id int, html string"), "id", "html").collect()
    assert [(r.href, r.anchor_text) for r in short] == [("/x", "one"), ("y.pdf", "two"), ("/x", "again")]


def test_state(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 2)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 5, 3), ("c", 7, 3)], "k string, v int, at int")
    table = state.StateTable(spark, f"file://{tmp_path}/state")
    assert table.read() is None
    for _ in range(2):
        table.upsert(old, ["k"], [F.desc("at")])
        table.upsert(new, ["k"], [F.desc("at")])
        assert sorted(map(tuple, table.read().collect())) == [("a", 1, 1), ("b", 5, 3), ("c", 7, 3)]
    assert len(table.vacuum()) == 2
    table.clear()
    assert table.read().count() == 0


def test_watermark_stops_before_a_failure(spark):
    rows = [(dt.datetime(2024, 1, 1, h), h != 3) for h in range(1, 6)]
    mark = state.advance(spark.createDataFrame(rows, "ts timestamp, ok boolean"), "ts", "ok").first().watermark
    assert dt.datetime(2024, 1, 1, 2) < mark < dt.datetime(2024, 1, 1, 3)


def test_ties_take_the_first_profile(spark):
    jobs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id int, v array<float>")
    profiles = spark.createDataFrame([(7, [2.0, 0.0]), (8, [4.0, 0.0])], "profile_id long, embedding array<float>")
    out = {r.id: (r.best_profile, r.similarity) for r in match.best_profile(jobs, "v", profiles).collect()}
    assert out == {1: (7, 1.0), 2: (None, None)}
    assert match.best_profile(jobs, "v", profiles.limit(0)).where("similarity is null").count() == 2


def test_stage_runner(spark, tmp_path):
    table, ran, fails = state.StateTable(spark, f"file://{tmp_path}/runs"), [], [1]

    def second(_):
        if fails:
            fails.pop()
            raise RuntimeError("once")
        ran.append("b")

    plan = [stages.Stage("b", second, needs=("a",)), stages.Stage("a", lambda s: ran.append("a"))]
    pauses = []
    assert stages.run(spark, plan, table, sleep=pauses.append) == ["a", "b"]
    assert ran == ["a", "b"] and pauses == [10.0]
    assert stages.run(spark, plan, table) == []
    with pytest.raises(ValueError, match="need each other"):
        stages.ordered([stages.Stage("x", second, needs=("y",))])


def test_models(spark):
    df = spark.createDataFrame([(1, "a b\nc"), (2, "boom")], "id int, p string")

    def client(prompt, budget):
        if prompt == "boom":
            raise ValueError("no")
        return models.echo_client(prompt, budget)

    out = {r.id: r for r in models.ask(df, "p", client, attempts=2).collect()}
    assert out[1].response == "- a b\n- c" and out[1].error is None
    assert out[2].response is None and out[2].error == "ValueError: no"
    vectors = [r.v for r in df.select(models.hashed_embedding(C("p")).alias("v")).collect()]
    assert len(vectors[0]) == 64 and sum(x * x for x in vectors[0]) == 3
    assert one(spark, models.translate_lines(C("x"), lambda s: s.upper()), x="नम २\nplain") == "नम 2\nplain"
    pages = models.over_bytes(spark.createDataFrame([(1, b"ab"), (2, b"")], "id int, content binary"), "content", lambda b: [(i, chr(c)) for i, c in enumerate(b)] if b else 1 / 0, "page int, text string").orderBy("id", "page").collect()
    assert [(r.id, r.page, r.text) for r in pages] == [(1, 0, "a"), (1, 1, "b"), (2, None, None)] and "ZeroDivision" in pages[2].error


def test_files(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "The pioneer_p2_text.txt").write_text(" page two \n")
    (tmp_path / "run" / "The pioneer_p1_text.txt").write_text("\n")
    (tmp_path / "run" / "x_p1_jobs.txt").write_text("- a\n\n - b \n")
    (tmp_path / "run" / "x_jobs_all.txt").write_text("📌 clerk\nclerk\n\ndriver")
    (tmp_path / "run" / "a.PDF").write_bytes(b"%PDF")
    (tmp_path / "run" / "debug_1.png").write_bytes(b"1")
    (tmp_path / "run" / "2.png").write_bytes(b"1")
    (tmp_path / "run" / "jobs.txt.log").write_text("x OCR failed on p1.png\nok\n")
    (tmp_path / "run" / "schedule.conf").write_text("# c\n\nmain|06:30|yes|run.sh\n")
    root = str(tmp_path / "run")
    assert [tuple(r) for r in files.page_texts(spark, root).collect()] == [("The_pioneer", 2, "page two")]
    assert [(r.issue, r.raw) for r in files.listing_lines(spark, root).orderBy("line_no").collect()] == [("x", "- a"), ("x", "- b")]
    assert sorted(r.job_text for r in files.jobs(spark, root).collect()) == ["clerk", "driver"]
    assert [r.name for r in files.pdf_files(spark, root).collect()] == ["a.PDF"]
    assert [r.name for r in files.image_files(spark, root).collect()] == ["2.png"]
    assert [r.image for r in files.failed_images(spark, f"{root}/jobs.txt.log").collect()] == ["p1.png"]
    assert [tuple(r) for r in files.schedule(spark, f"{root}/schedule.conf").collect()] == [("main", "06:30", "yes", "run.sh")]
    assert files.latest(spark, root, "*.png").endswith(".png")
    lines = files.text_lines(spark, root).where("path like '%x_p1%'").orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in lines] == [(0, "- a"), (1, ""), (2, " - b ")]
    kept = files.prefiltered(spark.createDataFrame([("a\x00 job post",), (" ",)], "text string"), "text", T.has_keywords(C("text"))).collect()
    assert [(r.text, r.status) for r in kept] == [("a job post", "candidate"), ("", "skipped")]


def test_boxes(spark):
    from quern.functions import boxes

    def block(w, h, area):
        return one(spark, boxes.is_block(F.lit(w), F.lit(h), F.lit(area)))

    assert block(81, 41, 5001) is True
    assert [block(80, 41, 5001), block(81, 40, 5001), block(81, 41, 5000), block(410, 41, 9999), block(82, 900, 9999)] == [False] * 5
    assert one(spark, boxes.reader_scale(F.lit(1536))) == 0.5
    values = [9] * 250 + [0] * 25 + [9] * 100 + [0] * 30 + [9] * 220 + [0] * 40
    profile = spark.createDataFrame([(1, x, float(v)) for x, v in enumerate(values)], "img int, x int, value double")
    # the last run of blanks reaches the edge and so is no gap; the middle part is too narrow
    assert sorted((r.x0, r.x1) for r in boxes.columns(profile, ["img"]).collect()) == [(0, 250), (405, 665)]


def test_messages(spark):
    from quern.functions import messages

    text = one(spark, messages.job_message(C("x"), F.lit(0.355), F.lit(None), F.lit("2025-07-01").cast("timestamp")), x="A&B Power Corporation needs clerks, apply by 3 July 2025")
    assert "<b>🏢 A&amp;B Power Corporation</b>" in text or "Power Corporation</b>" in text
    assert "🗓 Apply before: 3 July 2025" in text and "<b>Score:</b> N/A/5" in text and text.endswith("<i>Shortlisted on 1 July 2025</i>")
    now = F.lit("2025-07-01 10:05:00").cast("timestamp")
    assert one(spark, messages.summary_message(F.lit(3), F.lit(2), F.lit(1), F.lit(65), F.lit(None).cast("string"), now)) == ""
    assert "• <b>Runtime:</b> 1m 5s" in one(spark, messages.summary_message(F.lit(3), F.lit(2), F.lit(1), F.lit(65), C("x"), now), x="job")
    assert one(spark, messages.repository_line(C("x"), F.lit(""), F.lit("Python"), F.array(F.lit("a"), F.lit("b")), F.lit("r" * 300)), x="n") == "n | Python | a, b | " + "r" * 200


def test_keys(spark, tmp_path):
    from quern.operators import keys

    (tmp_path / "c.json").write_text('{"api_keys": "k1"}')
    assert keys.config(spark, f"file://{tmp_path}/c.json")["api_keys"] == ["k1"]
    assert keys.config(spark, f"file://{tmp_path}/none.json") == keys.DEFAULTS
    rotation = keys.Rotation(["a", "b"], ratelimit.Limits(burst=2))
    assert [rotation.next(0.0) for _ in range(5)] == ["a", "b", "a", "b", None]
    asked = spark.createDataFrame([(q, i, float(i % 3)) for q in "xy" for i in range(7)], "q string, i int, s double")
    out = keys.assign(asked, "q", ["s", "i"], "s", ["a", "b"], ratelimit.Limits(burst=1, per_minute=0.001)).orderBy("q", "s", "i").collect()
    assert [r.label for r in out] == ["a", "b", None, None, None, None, None] * 2
    errors = spark.createDataFrame([("no_key_available",), ("No API key available now",), ("x",), (None,)], "e string")
    assert [r[0] for r in errors.select(keys.no_key_available("e")).collect()] == [True, True, False, False]


def test_command_line(spark, tmp_path):
    from quern.__main__ import main

    spark.createDataFrame([("j1", "a", [1.0, 0.0]), ("j2", "b", [0.0, 1.0])], "job_id string, job_text string, embedding array<float>").write.parquet(f"{tmp_path}/jobs")
    spark.createDataFrame([(1, [1.0, 0.1])], "profile_id long, embedding array<float>").write.parquet(f"{tmp_path}/profiles")
    for k, n in ((1, 1), (2, 0)):
        main(["shortlist", f"{tmp_path}/jobs", f"{tmp_path}/profiles", f"{tmp_path}/out{k}", "--state", f"{tmp_path}/state"], spark)
        assert spark.read.parquet(f"{tmp_path}/out{k}").count() == n
    main(["history", f"{tmp_path}/state"], spark)
    main(["clear-history", f"{tmp_path}/state"], spark)
    assert state.StateTable(spark, f"{tmp_path}/state").read().count() == 0
