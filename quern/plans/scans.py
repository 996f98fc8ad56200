"""Catalogue queries of file scans: a table is written as the files that a scan expects, and read back by it."""

from __future__ import annotations

import posixpath

from pyspark.sql import functions as F

from quern import scratch
from quern.functions import text as T
from quern.operators import keys, models
from quern.plans.catalogue import query, t
from quern.sources import files, named

LINES = "SELECT conv_id, turn, role, '📌 ' || replace(text, chr(10), ' ') AS line FROM conversations"


@query("""
SELECT source AS issue, CAST(doc_id AS INT) AS page, md5(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS text_md5 FROM documents WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''
""")
def page_files(spark, sf_dir):
    """One text file for each page, read back by issue and page."""
    path, d = scratch.path(spark, "pages"), t(spark, sf_dir, "documents")
    named.write_files(d, path, F.format_string("%s/%s_p%d_text.txt", "lang", "source", "doc_id"), F.col("text"))
    # stored, as a sort looks at its input twice and each look would read all files
    return scratch.stored(files.page_texts(spark, path).select("issue", "page", F.md5("text").alias("text_md5")), "texts").orderBy("issue", "page")


@query("""
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'png' WHEN 2 THEN 'jpg' WHEN 3 THEN 'tiff' END AS kind, page_id % 2 = 0 AS at_top, CAST(octet_length(encode(html)) AS BIGINT) AS length, md5(encode(html)) AS content_md5
FROM pages WHERE page_id % 5 < 4 AND page_id % 7 <> 0
""")
def binary_scans(spark, sf_dir):
    """Page files of several suffixes, at the top and below, with debug images and others in between: what each scan finds."""
    path, p = scratch.path(spark, "images"), t(spark, sf_dir, "pages")
    i = F.col("page_id")
    suffix = F.element_at(F.array(*[F.lit(x) for x in (".PDF", ".png", ".JPG", ".tiff", ".txt")]), (i % 5 + 1).cast("int"))
    folder = F.when(i % 2 == 0, "").otherwise(F.concat(F.lit("issue"), (i % 3).cast("string"), F.lit("/")))
    prefix = F.when(i % 7 == 0, "debug_").otherwise("page_")
    named.write_files(p, path, F.concat(folder, prefix, i.cast("string"), suffix), F.col("html"))
    images, top = files.image_files(spark, path), files.image_files(spark, path, recursive=False).select("path").withColumn("at_top", F.lit(True))
    pdfs = files.pdf_files(spark, path).where("not startswith(name, 'debug_')")
    found = images.join(top, "path", "left").unionByName(pdfs.withColumn("at_top", F.regexp_extract("path", "/(issue\\d)/", 1) == ""))
    number = F.regexp_extract("name", r"_(\d+)\.", 1).cast("long")
    return found.select(number.alias("page_id"), F.lower(F.regexp_extract("name", r"\.(\w+)$", 1)).alias("kind"), F.coalesce("at_top", F.lit(False)).alias("at_top"), "length", F.md5("content").alias("content_md5"))


@query("""
SELECT doc_id, line_no, md5(line) AS line_md5 FROM (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l FROM documents))
""")
def line_files(spark, sf_dir):
    """A text file for each document, read back by lines. Ids may repeat or be null, so a file's name has the row's own number as well."""
    path, d = scratch.path(spark, "lines"), t(spark, sf_dir, "documents").where("text is not null")
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.format_string("_%d.txt", F.monotonically_increasing_id()))
    made = named.write_files(d, path, name, F.col("text"))
    number = F.nullif(F.regexp_extract(files.file_name(F.col("path")), r"^(-?\d+)_\d+\.txt$", 1), F.lit("")).cast("long")
    return files.text_lines(spark, path, made).select(number.alias("doc_id"), F.col("line_no").cast("long").alias("line_no"), F.md5("line").alias("line_md5"))


def _listings(spark, sf_dir, suffix: str) -> str:
    """Conversations as listing files, a line for each turn; one folder for each role of the first turn."""
    path, c = scratch.path(spark, "listings"), t(spark, sf_dir, "conversations")
    lines = c.select("conv_id", "turn", F.concat(F.lit("📌 "), T.one_line(F.col("text"))).alias("line"))
    rows = lines.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"]), "\n").alias("text"))
    named.write_files(rows, path, F.format_string("set%d/%d_p1_%s.txt", F.col("conv_id") % 3, F.col("conv_id"), F.lit(suffix)), F.concat("text", F.lit("\n\n")))
    return path


@query(f"""
WITH l AS ({LINES}), n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS line_no, line FROM l)
SELECT CAST(conv_id AS VARCHAR) AS issue, CAST(line_no AS INT) AS line_no, md5(trim(line)) AS raw_md5 FROM n
""")
def listing_files(spark, sf_dir):
    lines = files.listing_lines(spark, _listings(spark, sf_dir, "jobs"))
    return lines.select("issue", "line_no", F.md5("raw").alias("raw_md5"))


@query(f"""
WITH l AS (SELECT DISTINCT conv_id, ltrim(trim(line), '📌 ') AS job_text FROM ({LINES}))
SELECT 'set' || (conv_id % 3) || '/' || conv_id || '_p1_jobs_all.txt:' || substr(sha256(job_text), 1, 12) AS job_id, md5(job_text) AS text_md5 FROM l WHERE job_text <> ''
""")
def job_files(spark, sf_dir):
    return files.jobs(spark, _listings(spark, sf_dir, "jobs_all")).select("job_id", F.md5("job_text").alias("text_md5"))


@query("""
WITH c AS (SELECT lang, string_agg(source, chr(10) ORDER BY source) AS text FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY lang)
SELECT lang || '.txt' AS profile_id, replace('profile' || chr(10) || text, chr(10), ' ') AS text FROM c
""")
def profile_files(spark, sf_dir):
    """Profiles put together from parts and read back as one line each."""
    path, d = scratch.path(spark, "profiles"), t(spark, sf_dir, "documents")
    parts = d.select("lang", "source").distinct().groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("source")), "\n").alias("text"))
    named.write_files(parts, path, F.concat("lang", F.lit(".txt")), F.concat_ws("\n", F.lit("profile"), "text"))
    return files.profiles(spark, path)


@query("""
SELECT 'job-' || o_orderkey AS job_id, o_orderpriority AS job_text, CAST(o_custkey AS DOUBLE) AS similarity, o_orderstatus AS application_status FROM orders
""")
def json_arrays(spark, sf_dir):
    """Rows exported as JSON arrays and read back under the schema of an analysis; what does not fit would fail the read."""
    path, o = scratch.path(spark, "arrays"), t(spark, sf_dir, "orders")
    rows = o.select(F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"), F.col("o_orderpriority").alias("job_text"), F.col("o_custkey").cast("double").alias("similarity"), F.col("o_orderstatus").alias("application_status"))
    named.write_json_array(rows, path, F.format_string("jobs_%d.json", F.pmod(F.xxhash64("job_id"), F.lit(64))))
    return files.json_rows(spark, path).select("job_id", "job_text", "similarity", "application_status")


@query("SELECT DISTINCT 'img_' || user_id || '.png' AS image FROM events WHERE event_id % 4 < 3")
def failed_image_log(spark, sf_dir):
    """A log in which three lines of four report a failure, in three of the forms."""
    path, e = scratch.path(spark, "log"), t(spark, sf_dir, "events")
    image = F.concat(F.lit("img_"), F.col("user_id").cast("string"), F.lit(".png"))
    line = F.element_at(F.array(F.concat(F.lit("12:00 [⚠ missing] "), image), F.concat(F.lit("OCR failed on "), image, F.lit(" again")), F.concat(F.lit("[❌] No text from: "), image), F.concat(F.lit("read "), image, F.lit(" well"))), (F.col("event_id") % 4 + 1).cast("int"))
    files.write_text(e.select(line.alias("line")), path, "line")
    return files.failed_images(spark, path)


@query("""
SELECT 'task' || c_custkey AS name, printf('%02d:%02d', c_custkey % 24, c_custkey % 60) AS time, CASE WHEN c_nationkey % 2 = 0 THEN 'yes' ELSE 'no' END AS enabled, 'run ' || c_mktsegment AS command FROM customer
""")
def schedule_file(spark, sf_dir):
    path, c = scratch.path(spark, "schedule"), t(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    time = F.format_string("%02d:%02d", k % 24, k % 60)
    line = F.concat_ws(" | ", F.concat(F.lit("task"), k.cast("string")), time, F.when(F.col("c_nationkey") % 2 == 0, "yes").otherwise("no"), F.concat(F.lit("run "), "c_mktsegment"))
    lines = c.select(F.explode(F.array(line, F.lit("# a comment"), F.lit("  "))).alias("line"))
    files.write_text(lines, path, "line")
    return files.schedule(spark, path)


@query("""
SELECT source, CASE WHEN count(*) FILTER (lang = 'en') > 0 THEN 'default' ELSE 'other' END AS model, CAST(least(count(*), 3) AS INT) AS api_keys FROM documents GROUP BY source
""")
def config_files(spark, sf_dir):
    """A configuration for each source, with defaults for what it leaves out; a single key is a list of one."""
    path, d = scratch.path(spark, "config"), t(spark, sf_dir, "documents")
    made = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == "en").alias("english"))
    # the model is left to the default where there is English
    several = F.to_json(F.struct(F.when(F.col("english") == 0, "other").alias("model"), F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, F.least("n", F.lit(3)).cast("int")).alias("api_keys")))
    single = F.to_json(F.struct(F.when(F.col("english") == 0, "other").alias("model"), F.lit("a").alias("api_keys")))
    named.write_files(made, path, F.concat("source", F.lit(".json")), F.when(F.col("n") == 1, single).otherwise(several))
    read = [(r.source, keys.config(spark, posixpath.join(path, f"{r.source}.json"))) for r in made.select("source").limit(1000).collect()]  # as many files as sources
    return spark.createDataFrame([(source, c["model"], len(c["api_keys"])) for source, c in read], "source string, model string, api_keys int")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN md5(html) WHEN page_id % 3 = 1 THEN md5('') ELSE md5('[unsupported file: page' || page_id || '.zip]') END AS text_md5 FROM pages")
def attachment_texts(spark, sf_dir):
    p, i = t(spark, sf_dir, "pages"), F.col("page_id")
    name = F.concat(F.lit("page"), i.cast("string"), F.when(i % 3 == 0, ".TXT").otherwise(".zip"))
    return p.select("page_id", F.md5(files.attachment_text(name, F.when(i % 3 != 1, F.col("html").cast("binary")))).alias("text_md5"))


# Models: deterministic stand-ins, held against plain Python


@query()
def model_answers(spark, sf_dir):
    """Every turn asked of the stand-in model, row by row, with its token budget."""
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return models.ask(c, "text", models.echo_client).select("conv_id", "turn", "response", "error")


@query()
def batch_answers(spark, sf_dir):
    """The turns of a conversation in one request; what the answer to it lacks is asked for by itself."""
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("batch"), F.concat(F.lit("turn"), F.col("turn").cast("string"), F.lit(".txt")).alias("file"), "text")
    return models.ask_batches(c, "batch", "file", "text", models.forgetful_client)


@query()
def sentence_vectors(spark, sf_dir):
    return t(spark, sf_dir, "conversations").select("conv_id", "turn", models.hashed_embedding(F.col("text")).alias("vector"))


@query()
def translated_pages(spark, sf_dir):
    """Every other line of a document written in another script's digits and letters, and translated back by the stand-in."""
    line = F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    lines = t(spark, sf_dir, "documents").select("doc_id", line)
    foreign = F.when(F.col("line_no") % 2 == 0, F.translate("line", "aeiou0123456789", "अएइओउ०१२३४५६७८९")).otherwise(F.translate("line", "0123456789", "०१२३४५६७८९"))
    return lines.select("doc_id", "line_no", models.translate_lines(foreign, models.spelt_back).alias("line"))
