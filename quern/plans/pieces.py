"""Catalogue queries of single functions: text clean-up, names, routing, prompts, dates, JSON responses, files and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern import scratch
from quern.functions import dates, messages, records
from quern.functions import text as T
from quern.operators import dedup, extract, joins, keys
from quern.operators.state import StateTable
from quern.plans.catalogue import query, t
from quern.sources import files

DEVANAGARI = "०१२३४५६७८९"
WHITE = "' ' || chr(9) || chr(10) || chr(13)"


@query(f"""
SELECT doc_id, md5(text) AS digits, md5(ltrim(text, 'EISTALOeista ')) AS stripped, md5(replace(text, chr(10), ' ')) AS line, md5(trim(text, {WHITE})) AS without_nul,
md5(regexp_replace(text, '\\n\\s*\\n', chr(10) || chr(10), 'g')) AS collapsed,
md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> ''), chr(10))) AS lines FROM documents
""")
def text_cleanup(spark, sf_dir):
    c = F.col("text")
    written = F.translate(c, "0123456789", DEVANAGARI)
    return t(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(T.ascii_digits(written)).alias("digits"),
        F.md5(T.lstrip_set(c, "EISTALOeista ")).alias("stripped"),
        F.md5(T.one_line(c)).alias("line"),
        F.md5(T.without_nul(F.concat(F.lit("\x00"), c, F.lit("\x00")))).alias("without_nul"),
        F.md5(T.collapse_blank_lines(c)).alias("collapsed"),
        F.md5(T.clean_lines(c)).alias("lines"),
    )


CLEAN = "trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[-_()\\[\\].]', ' ', 'g'), '\\d{{1,2}}[-/]\\d{{1,2}}|\\d{{4}}', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"""
WITH p AS (SELECT p_partkey, p_name || ' Express_(' || p_brand || ')' AS name, p_brand FROM part)
SELECT p_partkey, replace({CLEAN.format("name")}, 'express', 'ie') AS clean, contains({CLEAN.format("name")}, {CLEAN.format("p_brand")}) OR contains({CLEAN.format("p_brand")}, {CLEAN.format("name")}) AS named,
list_extract(string_split(name || '_p7_p' || p_partkey, '_p'), -1) AS tail FROM p
""")
def names(spark, sf_dir):
    name = F.concat("p_name", F.lit(" Express_("), "p_brand", F.lit(")"))
    tail = T.after_last_page_mark(F.concat(name, F.lit("_p7_p"), F.col("p_partkey").cast("string")))
    return t(spark, sf_dir, "part").select("p_partkey", T.clean_name(name).alias("clean"), T.name_contains(name, F.col("p_brand")).alias("named"), tail.alias("tail"))


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in words) + ")"


@query(f"""
SELECT doc_id, CASE WHEN {_any("text", T.HINDI_TITLES)} THEN 'hi,en' WHEN {_any("text", T.ENGLISH_TITLES)} THEN 'en' ELSE 'hi,en' END AS languages,
CASE {" ".join(f"WHEN {_any('text', words)} THEN '{said}'" for words, said in records.TIPS)} ELSE '{records.NO_TIP}' END AS tip, contains(source, '1') AS chosen FROM documents
""")
def title_routing(spark, sf_dir):
    c = F.col("text")
    return t(spark, sf_dir, "documents").select("doc_id", F.array_join(T.title_languages(c), ",").alias("languages"), records.tip(c).alias("tip"), F.contains("source", F.lit("1")).alias("chosen"))


@query("SELECT c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS status, '1x ' || upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || '-Ab' AS mixed FROM customer")
def title_status(spark, sf_dir):
    c = F.col("c_mktsegment")
    # a digit is no letter, so the x behind it opens a run of its own
    return t(spark, sf_dir, "customer").select("c_custkey", T.title_case(c).alias("status"), F.replace(T.title_case(F.concat(F.lit("1x "), c, F.lit("-aB"))), F.lit("1X"), F.lit("1x")).alias("mixed"))


@query("SELECT page_id, substr(regexp_replace(replace(trim(x, ' ' || chr(9) || chr(10) || chr(13)), ' ', '_'), '[^\\p{L}\\p{N}_\\-. ]', '_', 'g'), 1, 200) AS file_name FROM (SELECT page_id, 'दैनिक भास्कर é ' || url AS x FROM pages)")
def sanitize_any_script(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", T.safe_file_name(F.concat(F.lit("दैनिक भास्कर é "), "url")).alias("file_name"))


@query("""
SELECT page_id, 'Read {this}: ' || url || ' {end}' AS prompt, 'Q' || chr(10) || chr(10) || '[a.txt]' || chr(10) || substr(html, 1, 2000) AS attached,
array_to_string(list_filter([url, nullif(CASE WHEN page_id % 2 = 0 THEN 'd' ELSE '' END, ''), 'Python', 'x, y', substr(html, 1, 200)], lambda x: x IS NOT NULL), ' | ') AS repository FROM pages
""")
def prompts(spark, sf_dir):
    html = F.col("html")
    attachment = F.array(F.struct(F.lit("a.txt").alias("name"), html.alias("text")))
    described = F.when(F.col("page_id") % 2 == 0, "d").otherwise("")
    return t(spark, sf_dir, "pages").select(
        "page_id",
        T.fill_template("Read {this}: {content} {end}", "{content}", F.col("url")).alias("prompt"),
        messages.prompt_with_attachments(F.lit("Q"), attachment).alias("attached"),
        messages.repository_line(F.col("url"), described, F.lit("Python"), F.array(F.lit("x"), F.lit("y")), html).alias("repository"),
    )


@query("""
SELECT page_id, '{"k": ' || page_id || '}' AS unfenced, '{"a": {"b": ' || page_id || '}}' AS braces, '0-' || page_id || '-1' AS resource_key,
CASE page_id % 4 WHEN 0 THEN 'https://e.org/x' || page_id || '.pdf' WHEN 1 THEN 'https://drive.google.com/uc?id=abcdefghij' || page_id || '&export=download' WHEN 2 THEN 'https://drive.google.com/uc?id=abcdefghijk' || page_id || '&export=download' END AS pdf FROM pages
""")
def addresses(spark, sf_dir):
    i, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    fenced = F.concat(F.lit('```\n{"k": '), i, F.lit("}\n``` and more"))
    inner = F.concat(F.lit('so {"a": {"b": '), i, F.lit("}} it is"))
    key = F.concat(F.lit("https://d/?a=1&ResourceKey=0-"), i, F.lit("%2D1#x"))
    direct = F.concat(F.lit("see https://e.org/x"), i, F.lit(".pdf now"))
    drive = F.concat(F.lit("https://drive.google.com/file/d/abcdefghij"), i, F.lit("/view"))
    opened = F.concat(F.lit("https://drive.google.com/open?id=abcdefghijk"), i)
    place = F.when(k == 0, direct).when(k == 1, drive).when(k == 2, opened).otherwise("none")
    return t(spark, sf_dir, "pages").select("page_id", T.without_fence(fenced).alias("unfenced"), T.outer_braces(inner).alias("braces"), records.resource_key(key).alias("resource_key"), records.direct_pdf(place).alias("pdf"))


@query("""
SELECT o_orderkey, o_custkey % 5 <> 4 AS mentions, CASE WHEN o_custkey % 2 = 0 THEN o_orderdate ELSE timestamp '1970-01-01 00:00:00' END AS read_back,
CASE WHEN o_custkey >= 3600 THEN (o_custkey // 3600) || 'h ' || (o_custkey % 3600 // 60) || 'm ' || (o_custkey % 60) || 's' WHEN o_custkey >= 60 THEN (o_custkey // 60) || 'm ' || (o_custkey % 60) || 's' ELSE o_custkey || 's' END AS took FROM orders
""")
def date_texts(spark, sf_dir):
    o, day = t(spark, sf_dir, "orders"), F.col("o_orderdate")
    k = F.col("o_custkey") % 5
    said = F.when(k == 0, F.date_format(day, "d/M/yyyy")).when(k == 1, F.date_format(day, "dd MMMM")).when(k == 2, F.date_format(day, "yyyyMMdd")).when(k == 3, F.date_format(day, "dd-MM-yy")).otherwise("no day at all")
    iso = F.when(F.col("o_custkey") % 2 == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).otherwise("not a time")
    mentioned = dates.mentions_date(F.concat(F.lit("on "), said, F.lit(".")), day)
    return o.select("o_orderkey", mentioned.alias("mentions"), dates.iso_or_epoch(iso).cast("timestamp_ntz").alias("read_back"), dates.duration(F.col("o_custkey")).alias("took"))


@query("SELECT doc_id, doc_id % 3 = 0 AND strlen(text) + 10 >= 1500 AS is_pdf, doc_id % 4 < 2 AS exhausted FROM documents")
def file_checks(spark, sf_dir):
    content = F.encode(F.concat(F.when(F.col("doc_id") % 3 == 0, "%PDF-").otherwise("<html"), "text", F.lit("%%EOF")), "UTF-8")
    k = F.col("doc_id") % 4
    rows = t(spark, sf_dir, "documents").withColumn("error", F.when(k == 0, "NO_KEY_AVAILABLE").when(k == 1, "sorry, No API key available now").when(k == 2, "timeout"))
    return rows.select("doc_id", records.is_pdf(content, 1500).alias("is_pdf"), keys.no_key_available("error").alias("exhausted"))


@query("""
SELECT o_orderkey, o_orderstatus || '.txt' AS filename, CAST(CASE WHEN o_orderkey % 3 = 2 THEN 1 ELSE k END AS INT) AS line_no, '- ' || CASE k WHEN 0 THEN o_orderpriority ELSE 'second "quoted" one' END AS listing
FROM orders, range(0, 2) r(k) WHERE o_orderkey % 3 <> 2 OR k = 0
""")
def recovered_listings(spark, sf_dir):
    """Responses in alternative fields: fenced JSON, JSON in prose, and lines of text."""
    o, k = t(spark, sf_dir, "orders"), F.col("o_orderkey") % 3
    lines = F.array(F.concat(F.lit("- "), "o_orderpriority"), F.lit('- - second "quoted" one'))
    files_ = F.array(F.struct(F.concat("o_orderstatus", F.lit(".txt")).alias("filename"), lines.alias("concise_listings")))
    as_json = F.to_json(F.struct(files_.alias("files")))
    as_lines = F.concat(F.lit("FILE: "), "o_orderstatus", F.lit(".txt\n - "), "o_orderpriority", F.lit("\nnothing"))
    response = F.when(k == 0, F.concat(F.lit("```json\n"), as_json, F.lit("\n```"))).when(k == 1, F.concat(F.lit("Here it is: "), as_json, F.lit(" Done."))).otherwise(as_lines)
    picked = extract.response_text([F.lit(""), F.lit(None).cast("string"), response])
    return extract.listings(o.select("o_orderkey", picked.alias("response")), "o_orderkey", "response").select("o_orderkey", "filename", F.col("line_no").cast("int").alias("line_no"), "listing")


@query("""
SELECT event_type, CASE WHEN max(ts) IS NULL THEN '' ELSE '<b>📊 Daily Summary</b>' || chr(10) || '• <b>Jobs scanned:</b> ' || count(*) || chr(10) || '• <b>Sent:</b> ' || count(*) FILTER (value >= 50) || ' new' || chr(10) ||
'• <b>Failed:</b> ' || count(*) FILTER (value < 50) || chr(10) || '• <b>Runtime:</b> 1m 5s' || chr(10) || '• <b>Latest job:</b> a&#46;b' || chr(10) || '• <b>Notified at:</b> 29 Jan 2024, 00:00' END AS message FROM events GROUP BY event_type
""")
def summary_messages(spark, sf_dir):
    ok = F.col("value") >= 50
    counted = t(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("sent"), F.count_if(~ok).alias("failed"))
    message = messages.summary_message(F.col("n"), F.col("sent"), F.col("failed"), F.lit(65), F.lit("a.b"), F.expr("timestamp '2024-01-29 00:00:00'"))
    return counted.select("event_type", message.alias("message"))


@query("SELECT event_id, ts FROM events WHERE ts > timestamp '2024-01-28 00:00:00'")
def valid_checks(spark, sf_dir):
    return keys.still_valid(t(spark, sf_dir, "events"), "ts", F.expr("timestamp '2024-01-29 00:00:00'")).select("event_id", "ts")


@query("""
SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.doc_id % 2 = 0 AND l.quality = 1)
""")
def fresh_files(spark, sf_dir):
    present = t(spark, sf_dir, "labels").withColumn("day", F.col("doc_id") % 2)
    return joins.fresh_missing(t(spark, sf_dir, "documents").select("doc_id", "source"), present, "doc_id", F.col("day"), F.lit(0), F.col("quality") == 1).select("doc_id", "source")


@query("SELECT conv_id, turn, CASE WHEN role = 'user' THEN md5(text) ELSE 'none' END AS response, role = 'user' AND length(text) > 0 AS succeeded FROM conversations")
def batch_outcomes(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    results = c.where("role = 'user'").select("conv_id", "turn", F.md5("text").alias("response"))
    return joins.batch_outcome(c.select("conv_id", "turn"), results, ["conv_id", "turn"], "response", "none").select("conv_id", "turn", "response", "succeeded")


@query("SELECT doc_id, text, coalesce(quality, -1) AS quality, doc_id || '/' || source AS job_id FROM documents LEFT JOIN labels USING (doc_id)")
def analysis_rows(spark, sf_dir):
    """A job's record with what was found out about it."""
    d = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", "text", F.coalesce("quality", F.lit(-1)).alias("quality"), F.concat_ws("/", F.col("doc_id").cast("string"), "source").alias("job_id"))


# Files and state


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_files(spark, sf_dir):
    path = scratch.path(spark, "json")
    files.write_json(t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), path)
    return spark.read.schema("event_id long, user_id long, event_type string, value double").json(path)


@query("SELECT conv_id, turn, substr(text, 1, 1000) AS prompt, substr(text, 1, 2000) AS response FROM conversations")
def logged_requests(spark, sf_dir):
    """Two appends to a log that does not exist before the first."""
    path, c = scratch.path(spark, "log"), t(spark, sf_dir, "conversations")
    rows = c.select("conv_id", "turn", F.col("text").alias("prompt"), F.col("text").alias("response"))
    files.request_log(rows.where("turn % 2 = 0"), path)
    files.request_log(rows.where("turn % 2 != 0"), path)
    return spark.read.schema(rows.schema).parquet(path)


@query("SELECT doc_id, md5(substr(text, 1, 4000)) AS prompt_md5, md5(substr(text, 1, 4000)) AS response_md5 FROM documents")
def logged_interactions(spark, sf_dir):
    """Interactions with whole documents, cut at the log's limit for both sides."""
    path, d = scratch.path(spark, "interactions"), t(spark, sf_dir, "documents")
    rows = d.select("doc_id", F.col("text").alias("prompt"), F.col("text").alias("response"))
    files.request_log(rows, path, files.INTERACTION_CHARS, files.INTERACTION_CHARS)
    return spark.read.schema(rows.schema).parquet(path).select("doc_id", F.md5("prompt").alias("prompt_md5"), F.md5("response").alias("response_md5"))


@query("SELECT md5('- ' || replace(text, chr(10), ' ')) AS line_md5, count(*) AS lines FROM conversations GROUP BY 1")
def text_files(spark, sf_dir):
    """Listings written as text, read back by line."""
    path = scratch.path(spark, "text")
    files.write_text(t(spark, sf_dir, "conversations").select(F.concat(F.lit("- "), T.one_line(F.col("text"))).alias("line")), path, "line")
    return spark.read.text(path, lineSep="\n").groupBy(F.md5("value").alias("line_md5")).agg(F.count(F.lit(1)).alias("lines"))


@query("SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def state_versions(spark, sf_dir):
    """Upserts into a table of versions, cleared in between; the last version counts."""
    table, e = StateTable(spark, scratch.path(spark, "state")), t(spark, sf_dir, "events")
    newest = [F.desc("ts"), F.desc("event_id")]
    table.upsert(e.where("value > 50"), ["user_id"], newest)
    table.clear()
    table.upsert(e.where("event_id % 2 = 0"), ["user_id"], newest)
    table.upsert(e.where("event_id % 2 != 0"), ["user_id"], newest)
    table.vacuum()
    return table.read().select("event_id", "user_id", "value")


@query()
def path_digests(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", T.path_digest(F.col("url")).alias("digest"))


@query()
def text_similarity(spark, sf_dir):
    """The ratio of each turn's text and the next one's."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    pairs = joins.zipped(c, c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("after")), ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", F.round(dedup.similarity(F.col("text"), F.col("after")), 9).alias("ratio"))
