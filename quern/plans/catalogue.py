"""The catalogue of queries (name -> function of session and folder) and of the SQL each is compared with.

Every query runs over its whole table. Queries without SQL are order-dependent folds or need a parser; tests hold them
against plain Python. The driver's tables have no job adverts, so keyword and script parameters are bound to what the
tables hold; the functions' defaults are the original ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import boxes, dates, messages, records
from quern.functions import text as T
from quern.operators import dedup, extract, joins, keys, match, quantiles, ratelimit, state, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORDS = ("the", "and", "que", "der", "les", "und", "tion", "ment", "posts", "post")
CUT = "timestamp '2024-01-20 00:00:00'"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Matching

MATCHED = """
WITH p AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id < 3),
s AS (SELECT e.vec_id, p.pid, list_cosine_similarity(e.embedding::DOUBLE[], p.v) AS sim FROM embeddings e CROSS JOIN p WHERE e.vec_id >= 3),
b AS (SELECT vec_id, pid AS best_profile, round(sim, 6) AS similarity, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, pid) AS rn FROM s)
"""


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "embeddings")
    found = match.best_profile(e.where("vec_id >= 3"), "embedding", e.where("vec_id < 3").withColumnRenamed("vec_id", "profile_id"))
    return found.select("vec_id", "best_profile", "similarity")


@query(MATCHED + "SELECT vec_id, best_profile, similarity FROM b WHERE rn = 1 AND similarity >= 0.3")
def match_shortlist(spark, sf_dir):
    best = match.shortlist(matched(spark, sf_dir))
    return best.select("vec_id", "best_profile", F.round("similarity", 6).alias("similarity")).orderBy(F.desc("similarity"), "vec_id")


@query(MATCHED + "SELECT CASE WHEN similarity > 0.37 THEN 'high' WHEN similarity > 0.34 THEN 'good' ELSE 'moderate' END AS tier, count(*) AS n FROM b WHERE rn = 1 AND similarity >= 0.3 GROUP BY 1")
def match_tiers(spark, sf_dir):
    return match.shortlist(matched(spark, sf_dir)).groupBy(records.tier(F.col("similarity")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH p AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id < 3)
SELECT e.vec_id, round(max(list_cosine_similarity(e.embedding::DOUBLE[], p.v)) FILTER (pid = 0), 6) AS p0, round(max(list_cosine_similarity(e.embedding::DOUBLE[], p.v)) FILTER (pid = 1), 6) AS p1,
round(max(list_cosine_similarity(e.embedding::DOUBLE[], p.v)) FILTER (pid = 2), 6) AS p2 FROM embeddings e CROSS JOIN p WHERE e.vec_id >= 3 GROUP BY 1
""")
def match_debug_map(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings")
    rows = [(r[0], list(r[1])) for r in e.where("vec_id < 3").select("vec_id", F.col("embedding").cast("array<double>")).orderBy("vec_id").collect()]
    scores = F.map_from_entries(F.transform(match.profile_scores(F.col("embedding"), rows)[0], lambda x: F.struct(x["profile_id"], x["similarity"])))
    mapped = e.where("vec_id >= 3").select("vec_id", scores.alias("m"))
    return mapped.select("vec_id", *[F.round(F.col("m")[k], 6).alias(f"p{k}") for k in range(3)])


# Text predicates


@query("""
SELECT doc_id, round(CASE WHEN length(text) = 0 THEN 0 ELSE length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) / length(text) END, 9) AS ratio,
length(text) > 0 AND length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g')) / length(text) >= 0.05 AS is_other FROM documents
""")
def script_ratio(spark, sf_dir):
    other = r"^\x00-\x7F"
    share = F.coalesce(F.try_divide(F.length(F.regexp_replace("text", f"[{other[1:]}]", "")), F.length("text")), F.lit(0.0))
    return t(spark, sf_dir, "documents").select("doc_id", F.round(share, 9).alias("ratio"), ((share >= 0.05) & (F.length("text") > 0)).alias("is_other"))


@query("""
SELECT doc_id, coalesce(length(regexp_replace(text, '[^\\x{0900}-\\x{097F}A-Za-z0-9]', '', 'g')) / nullif(length(regexp_replace(text, '\\s', '', 'g')), 0) < 0.8, true) AS gibberish FROM documents
""")
def gibberish_flag(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", T.is_gibberish(F.col("text"), 0.8).alias("gibberish"))


@query("SELECT doc_id, score, score >= 2 AS passes FROM (SELECT doc_id, CAST(" + " + ".join(f"contains(lower(text), '{w}')::INT" for w in WORDS) + " AS INT) AS score FROM documents)")
def keyword_prefilter(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", T.keyword_score(F.col("text"), WORDS).alias("score"), T.has_keywords(F.col("text"), WORDS).alias("passes"))


@query("""
SELECT class, count(*) AS n FROM (SELECT CASE WHEN length(text) < 20 THEN 'tiny' WHEN length(regexp_replace(text, '[^A-Za-z]', '', 'g')) < 0.12 * length(text) THEN 'graphic'
WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) <= 12 OR length(text) <= 50 THEN 'short' ELSE 'ok' END AS class FROM documents) GROUP BY 1
""")
def short_text_filter(spark, sf_dir):
    c = F.col("text")
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    kind = F.when(F.length(c) < 20, "tiny").when(letters < 0.12 * F.length(c), "graphic").when(T.is_short(c), "short").otherwise("ok")
    return t(spark, sf_dir, "documents").groupBy(kind.alias("class")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, substr(sha256(text), 1, 12) AS hash12, source || '/' || lang || ':' || substr(sha256(text), 1, 12) AS stable_id FROM documents")
def stable_id(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.substring(F.sha2("text", 256), 1, 12).alias("hash12"), T.stable_id([F.col("source"), F.col("lang")], F.col("text")).alias("stable_id"))


@query("""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(url), '[-_()\\[\\].]', ' ', 'g'), '\\d{1,2}[-/]\\d{1,2}|\\d{4}', '', 'g'), '\\s+', ' ', 'g')) AS name FROM pages
""")
def norm_text(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", T.normalise_name(F.col("url")).alias("name"))


@query("SELECT page_id, substr(regexp_replace(replace(url, ' ', '_'), '[^\\p{L}\\p{N}_\\-. ]', '_', 'g'), 1, 200) AS file_name FROM pages")
def sanitize_name(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", T.safe_file_name(F.col("url")).alias("file_name"))


def _replaced(pairs) -> str:
    out = "html"
    for a, b in pairs:
        out = f"replace({out}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    return out


@query(f"SELECT page_id, md5({_replaced(T.HTML_ESCAPES)}) AS plain, md5({_replaced(T.CODE_ESCAPES)}) AS code FROM pages")
def html_escape(spark, sf_dir):
    html = F.col("html")
    return t(spark, sf_dir, "pages").select("page_id", F.md5(T.escape_html(html)).alias("plain"), F.md5(T.escape_code(html)).alias("code"))


@query("""
SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '[\\f\\x{FFFD}]', '', 'g'), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13))) AS cleaned,
CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS preview FROM documents
""")
def clean_text(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean_ocr(F.col("text"))).alias("cleaned"), T.preview(F.col("text"), 120).alias("preview"))


@query("""
WITH n AS (SELECT doc_id, source || '_p' || (doc_id % 40) || '_text.txt' AS name FROM documents)
SELECT doc_id, coalesce(nullif(regexp_extract(name, '_p(\\d+)', 1), ''), '0') AS page, CAST(coalesce(nullif(regexp_extract(name, '_p(\\d+)_text\\.txt$', 1), ''), '-1') AS INT) AS page_no,
regexp_replace(name, '_p\\d+.*$', '') AS issue FROM n
""")
def page_names(spark, sf_dir):
    name = F.concat(F.col("source"), F.lit("_p"), (F.col("doc_id") % 40).cast("string"), F.lit("_text.txt"))
    return t(spark, sf_dir, "documents").select("doc_id", T.page_number(name).alias("page"), T.anchored_page_number(name).alias("page_no"), T.issue_prefix(name).alias("issue"))


def _any(c: str, keys) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{k}')" for k in keys) + ")"


@query("SELECT doc_id, CASE " + " ".join(f"WHEN {_any('text', keys)} THEN '{name}'" for name, keys in records.PROFILES) + " ELSE 'hybrid' END AS profile FROM documents")
def profile_routing(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", records.choose_profile(F.col("text")).alias("profile"))


# Windows


@query("""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(CASE WHEN len(w) <= 1000 THEN [0] ELSE range(0, len(w), 950) END) AS word_start FROM w WHERE len(w) > 0)
SELECT doc_id, CAST(word_start // 950 + 1 AS INT) AS batch_no, CAST(word_start AS INT) AS word_start, CAST(len(list_slice(w, word_start + 1, word_start + 1000)) AS INT) AS n_words,
md5(array_to_string(list_slice(w, word_start + 1, word_start + 1000), ' ')) AS text_md5 FROM s
""")
def word_windows(spark, sf_dir):
    out = windows.word_windows(t(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return out.select("doc_id", "batch_no", "word_start", "n_words", F.md5("text").alias("text_md5"))


@query("SELECT o_orderkey, o_custkey, row_number() OVER w AS pos, (row_number() OVER w - 1) // 4 AS chunk FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def chunk_assignment(spark, sf_dir):
    return windows.chunk_numbers(t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 4).select("o_orderkey", "o_custkey", F.col("pos").cast("long").alias("pos"), "chunk")


@query("""
SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= floor(count(*) OVER (PARTITION BY source) * 2 / 3) THEN 'first' ELSE 'second' END AS side FROM documents
""")
def ratio_split(spark, sf_dir):
    return windows.ratio_split(t(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")], ranged=True).select("doc_id", "side")


@query("""
SELECT doc_id, CASE WHEN n_chars > 3000 THEN 'gpu' ELSE 'cpu' END AS route, CAST(CASE WHEN n_chars < 2000 THEN 1200 WHEN n_chars < 6000 THEN 2500 ELSE 4000 END AS INT) AS budget,
CAST(CASE WHEN n_chars < 8000 THEN 3000 WHEN n_chars < 20000 THEN 6000 ELSE 8000 END AS INT) AS batch_budget FROM documents
""")
def route_by_size(spark, sf_dir):
    n = F.col("n_chars")
    return t(spark, sf_dir, "documents").select("doc_id", windows.route_by_size(n).alias("route"), records.token_budget(n).alias("budget"), records.token_budget(n, batch=True).alias("batch_budget"))


@query("""
WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
f AS (
  SELECT source, doc_id, rn, 0::BIGINT AS batch, CASE WHEN n_chars > 3500 THEN 0 ELSE n_chars END AS used, CASE WHEN n_chars > 3500 THEN 2 ELSE 1 END AS cnt FROM d WHERE rn = 1
  UNION ALL
  SELECT d.source, d.doc_id, d.rn, CASE WHEN d.n_chars > 3500 OR f.cnt >= 2 OR f.used + d.n_chars > 5000 THEN f.batch + 1 ELSE f.batch END,
    CASE WHEN d.n_chars > 3500 THEN 0 WHEN f.cnt >= 2 OR f.used + d.n_chars > 5000 THEN d.n_chars ELSE f.used + d.n_chars END,
    CASE WHEN d.n_chars > 3500 THEN 2 WHEN f.cnt >= 2 OR f.used + d.n_chars > 5000 THEN 1 ELSE f.cnt + 1 END
  FROM f JOIN d ON d.source = f.source AND d.rn = f.rn + 1)
SELECT source, doc_id, batch FROM f
""")
def greedy_packing(spark, sf_dir):
    return windows.pack_greedy(t(spark, sf_dir, "documents").select("source", "doc_id", "n_chars"), ["source"], "doc_id", "n_chars").select("source", "doc_id", "batch")


@query("SELECT o_orderkey, coalesce(CAST(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS VARCHAR), '') AS next_item FROM orders")
def next_item(spark, sf_dir):
    return windows.next_in_order(t(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], "o_orderkey").select("o_orderkey", "next_item")


@query("""
WITH n AS (SELECT user_id, value < 20 AS hit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
h AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS island FROM n WHERE hit)
SELECT user_id, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS length FROM h GROUP BY user_id, island HAVING count(*) >= 2
""")
def gap_runs(spark, sf_dir):
    return windows.runs_where(t(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], F.col("value") < 20, 2)


@query("SELECT event_id, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w + 1e-9), 6) AS scaled FROM events WINDOW w AS (PARTITION BY event_type)")
def min_max_scale(spark, sf_dir):
    return windows.min_max_scaled(t(spark, sf_dir, "events"), ["event_type"], "value").select("event_id", F.round("scaled", 6).alias("scaled"))


@query("SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS VARCHAR) || '. ' || role AS line FROM conversations")
def numbered_lines(spark, sf_dir):
    return windows.numbered_lines(t(spark, sf_dir, "conversations"), ["conv_id"], [F.col("turn")], "role").select("conv_id", "turn", "line")


# Aggregation and deduplication


@query("SELECT conv_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE trim(text) <> '')) AS page_md5, count(*) AS turns FROM conversations GROUP BY conv_id")
def page_text_assembly(spark, sf_dir):
    parts = F.array_sort(F.collect_list(F.when(T.non_empty(F.col("text")), F.struct("turn", "text"))))
    page = F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n")
    return t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.md5(page).alias("page_md5"), F.count(F.lit(1)).alias("turns"))


STATUS = "SELECT source, count(*) AS total, count(*) FILTER (coalesce(quality = 1, false)) AS success, count(*) FILTER (NOT coalesce(quality = 1, false)) AS failed, bool_and(coalesce(quality = 1, false)) AS complete FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source"


@query(STATUS)
def page_summary(spark, sf_dir):
    return state.group_status(t(spark, sf_dir, "documents").select("doc_id", "source"), t(spark, sf_dir, "labels"), "source", "doc_id", F.col("quality") == 1)


@query("SELECT doc_id, source FROM (SELECT doc_id, source, bool_and(coalesce(quality = 1, false)) OVER (PARTITION BY source) AS ok FROM documents LEFT JOIN labels USING (doc_id)) WHERE NOT ok")
def strict_resume(spark, sf_dir):
    return state.resume(t(spark, sf_dir, "documents").select("doc_id", "source"), t(spark, sf_dir, "labels"), "source", "doc_id", F.col("quality") == 1, strict=True).select("doc_id", "source")


@query("SELECT doc_id, source FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT coalesce(quality = 1, false)")
def partial_resume(spark, sf_dir):
    return state.resume(t(spark, sf_dir, "documents").select("doc_id", "source"), t(spark, sf_dir, "labels"), "source", "doc_id", F.col("quality") == 1).select("doc_id", "source")


@query("SELECT source, min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY source, text")
def exact_distinct(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy("source", "text").agg(F.min("doc_id").alias("doc_id")).select("source", "doc_id", F.md5("text").alias("text_md5"))


@query("""
WITH p AS (SELECT source, text, count(*) AS n FROM documents GROUP BY source, text)
SELECT source, CAST(sum(n) AS BIGINT) AS raw, count(*) AS distinct_rows, round(100.0 * (sum(n) - count(*)) / sum(n), 6) AS reduction FROM p GROUP BY ROLLUP (source)
""")
def dup_report(spark, sf_dir):
    return dedup.duplicate_report(t(spark, sf_dir, "documents"), "source", "text").withColumn("reduction", F.round("reduction", 6))


@query()
def fuzzy_distinct(spark, sf_dir):
    """Whole documents of a source and language, in the order of their ids."""
    return dedup.fuzzy_distinct(t(spark, sf_dir, "documents").select("source", "lang", "doc_id", "text"), ["source", "lang"], "doc_id", "text").drop("text")


@query()
def fuzzy_turns(spark, sf_dir):
    return dedup.fuzzy_distinct(t(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), ["conv_id"], "turn", "text")


@query("""
WITH s AS (SELECT value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n, event_type FROM events),
q AS (SELECT event_type, avg(value) AS mean, min(value) AS low, max(value) AS high, any_value(n) AS n, floor(19.0 * (any_value(n) + 1) / 20) AS j, 19 * (any_value(n) + 1) % 20 AS d FROM s GROUP BY event_type)
SELECT q.event_type, round(mean, 6) AS mean, low, high, round(CASE WHEN q.n < 20 THEN high ELSE (a.value * (20 - d) + b.value * d) / 20 END, 6) AS p95
FROM q JOIN s a ON a.event_type = q.event_type AND a.rn = least(greatest(j, 1), q.n - 1) JOIN s b ON b.event_type = q.event_type AND b.rn = least(greatest(j, 1), q.n - 1) + 1
""")
def latency_stats(spark, sf_dir):
    """Mean, least, greatest and the 95th percentile of the values that are not null."""
    e = t(spark, sf_dir, "events")
    stats = e.groupBy("event_type").agg(F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"))
    out = windows.with_group_values(quantiles.exclusive_p95(e, ["event_type"], "value"), stats, ["event_type"])
    return out.select("event_type", F.round("mean", 6).alias("mean"), "low", "high", F.round("p95", 6).alias("p95"))


@query("""
WITH s AS MATERIALIZED (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS t, count(*) OVER (PARTITION BY event_type) AS n_all FROM events),
c AS (SELECT DISTINCT event_type, t AS n FROM s WHERE t % 20 = 0 OR t = n_all),
r AS (SELECT c.event_type, c.n, s.value, row_number() OVER (PARTITION BY c.event_type, c.n ORDER BY s.value) AS rn FROM c JOIN s ON s.event_type = c.event_type AND s.t <= c.n),
q AS (SELECT event_type, n, least(greatest(19 * (n + 1) // 20, 1), greatest(n - 1, 1)) AS j, 19 * (n + 1) % 20 AS d FROM c)
SELECT r.event_type, r.n, round(sum(value), 2) AS total, round(CASE WHEN r.n < 20 THEN max(value) ELSE (max(value) FILTER (rn = j) * (20 - any_value(d)) + max(value) FILTER (rn = j + 1) * any_value(d)) / 20 END, 9) AS p95
FROM r JOIN q ON q.event_type = r.event_type AND q.n = r.n GROUP BY r.event_type, r.n
""")
def latency_log(spark, sf_dir):
    """Sum (a mean would be rounded at ties) and 95th percentile after every 20th call of a type, and after its last."""
    out = quantiles.running_p95(t(spark, sf_dir, "events"), ["event_type"], [F.col("ts"), F.col("event_id")], "value")
    return out.select("event_type", "n", F.round(F.col("mean") * F.col("n"), 2).alias("total"), F.round("p95", 9).alias("p95"))


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (value >= 10) AS success, count(*) FILTER (value < 10) AS failed, round(100.0 * count(*) FILTER (value >= 10) / count(*), 6) AS success_pct,
CAST(sum(user_id) AS BIGINT) AS tokens, round(sum(user_id) / 10000.0 * 0.375, 6) AS cost FROM events GROUP BY event_type
""")
def run_totals(spark, sf_dir):
    ok = F.col("value") >= 10
    out = t(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"), F.sum("user_id").alias("tokens"))
    share, cost = F.coalesce(F.try_divide(100.0 * F.col("success"), F.col("n")), F.lit(0.0)), F.col("tokens") / 10000 * 0.375
    return out.select("event_type", "n", "success", "failed", F.round(share, 6).alias("success_pct"), "tokens", F.round(cost, 6).alias("cost"))


@query("""
SELECT doc_id, n_chars // 4 AS prompt_tokens, length(source) // 4 AS response_tokens, n_chars // 4 + length(source) // 4 AS total_tokens,
round(CASE WHEN doc_id % 7 > 0 THEN (n_chars // 4 + length(source) // 4) / (doc_id % 7) ELSE 0 END, 6) AS tokens_per_second FROM documents
""")
def token_metrics(spark, sf_dir):
    out = t(spark, sf_dir, "documents").select("doc_id", *records.token_metrics(F.col("n_chars"), F.length("source"), F.col("doc_id") % 7))
    return out.withColumn("tokens_per_second", F.round("tokens_per_second", 6))


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang, source")
def status_counts(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


# State


@query("SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_latest(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    cut = F.expr(CUT)
    merged = state.upsert(e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return merged.select("event_id", "user_id", "event_type", "value")


@query(f"""
SELECT event_id, k FROM (SELECT event_id, event_id % 1000 AS k, row_number() OVER (PARTITION BY event_id % 1000 ORDER BY ts, event_id) AS rn FROM events WHERE ts >= {CUT}) x
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM events h WHERE h.user_id = x.k AND h.ts < {CUT} AND h.value > 95)
""")
def new_only(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    found = e.where(F.col("ts") >= F.expr(CUT)).select("event_id", "ts", (F.col("event_id") % 1000).alias("k"))
    history = e.where((F.col("ts") < F.expr(CUT)) & (F.col("value") > 95)).select(F.col("user_id").alias("k"))
    return match.only_new(found, history, "k", [F.col("ts"), F.col("event_id")]).select("event_id", "k")


@query(f"SELECT event_id, ts FROM events WHERE ts > {CUT}")
def incremental_since(spark, sf_dir):
    return state.newer_than(t(spark, sf_dir, "events"), "ts", F.expr(CUT)).select("event_id", "ts")


@query("SELECT CASE WHEN min(ts) FILTER (value < 1) IS NULL THEN max(ts) ELSE min(ts) FILTER (value < 1) - INTERVAL 1 MICROSECOND END AS watermark FROM events")
def next_watermark(spark, sf_dir):
    return state.advance(t(spark, sf_dir, "events").withColumn("ok", F.col("value") >= 1), "ts", "ok")


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def recent_n(spark, sf_dir):
    return joins.newest(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 50)


@query("SELECT event_id, user_id FROM events WHERE ts + INTERVAL 24 HOUR > timestamp '2024-01-29 00:00:00'")
def ttl_skips(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("expiry", F.col("ts") + F.expr("interval 24 hours"))
    return state.live(e, "expiry", F.expr("timestamp '2024-01-29 00:00:00'")).select("event_id", "user_id")


@query("""
SELECT event_type, count(*) AS n, CAST(sum(length(props)) AS BIGINT) AS bytes, CASE WHEN sum(length(props)) <= 1024 THEN printf('%.2f B', sum(length(props))::DOUBLE) ELSE
CASE WHEN sum(length(props)) <= 1048576 THEN printf('%.2f KB', sum(length(props)) / 1024.0::DOUBLE) ELSE printf('%.2f MB', sum(length(props)) / 1048576.0::DOUBLE) END END AS readable
FROM events WHERE ts < timestamp '2024-01-29 00:00:00' - INTERVAL 7 DAY GROUP BY event_type
""")
def retention(spark, sf_dir):
    gone = state.expired(t(spark, sf_dir, "events"), "ts", F.expr("timestamp '2024-01-29 00:00:00'"), 7)
    out = gone.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("props")).alias("bytes"))
    return out.withColumn("readable", records.readable_size(F.col("bytes").cast("double")))


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
f AS (
  SELECT event_id, user_id, rn, us AS refilled, us // 86400000000 AS day, 4.0::DOUBLE AS tokens, 1 AS used, 'allowed' AS decision FROM e WHERE rn = 1
  UNION ALL
  SELECT event_id, user_id, rn, CASE WHEN quota THEN refilled ELSE us END, us // 86400000000,
    CASE WHEN quota THEN tokens WHEN filled < 1 THEN filled ELSE filled - 1 END, CASE WHEN quota OR filled < 1 THEN used ELSE used + 1 END,
    CASE WHEN quota THEN 'quota' WHEN filled < 1 THEN 'tokens' ELSE 'allowed' END
  FROM (SELECT e.event_id, e.user_id, e.rn, e.us, f.refilled, f.tokens, CASE WHEN f.day = e.us // 86400000000 THEN f.used ELSE 0 END AS used,
      (CASE WHEN f.day = e.us // 86400000000 THEN f.used ELSE 0 END) >= 20 AS quota, least(5.0::DOUBLE, f.tokens + (e.us / 1e6::DOUBLE - f.refilled / 1e6::DOUBLE) * 15 / 60) AS filled
    FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1))
SELECT event_id, user_id, ts, decision FROM f JOIN events USING (event_id, user_id)
""")
def token_bucket(spark, sf_dir):
    return ratelimit.token_bucket(t(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id")


# Extraction


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


RESPONSES = "SELECT conv_id, turn, 'FILE: ' || role || '.txt' || chr(10) || '- ' || replace(text, '. ', '.' || chr(10) || '- ') AS response FROM conversations"


@query(f"""
WITH r AS ({RESPONSES}), l AS (SELECT conv_id, turn, unnest(string_split(response, chr(10))) AS line, generate_subscripts(string_split(response, chr(10)), 1) - 1 AS line_no, response FROM r)
SELECT conv_id * 100 + turn AS id, regexp_extract(response, 'FILE: (\\w+\\.txt)', 1) AS filename, CAST(line_no AS INT) AS line_no, md5('- ' || regexp_replace(trim(line, ' ' || chr(9) || chr(13)), '^(?:- )+', '')) AS listing_md5
FROM l WHERE starts_with(trim(line, ' ' || chr(9) || chr(13)), '- ')
""")
def response_listings(spark, sf_dir):
    text = F.concat(F.lit("FILE: "), "role", F.lit(".txt\n- "), F.replace("text", F.lit(". "), F.lit(".\n- ")))
    r = t(spark, sf_dir, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), text.alias("response"))
    return extract.text_listings(r, "id", "response").select("id", "filename", "line_no", F.md5(F.concat(F.lit("- "), F.regexp_replace("listing", "^(?:- )+", ""))).alias("listing_md5"))


@query("""
WITH r AS (SELECT doc_id, 'Match Score: ' || (doc_id % 6) || CASE WHEN doc_id % 5 = 0 THEN '.5' ELSE '' END || '/5. Verdict: ' || CASE WHEN doc_id % 3 = 0 THEN 'Not recommended' ELSE CASE WHEN doc_id % 7 = 0 THEN 'Unclear' ELSE 'Recommended' END END AS response FROM documents),
l AS (SELECT doc_id, lower(response) AS x FROM r)
SELECT doc_id, (contains(x, 'recommended') AND NOT contains(x, 'not recommended')) OR contains(x, 'match score: 4') OR contains(x, 'match score: 5') OR (contains(x, 'match score: 3') AND contains(x, 'recommended')) OR contains(x, 'verdict: recommended') AS promising,
regexp_extract(x, 'match score: (.*?)/5', 1) AS score_text, TRY_CAST(regexp_extract(x, 'match score: (.*?)/5', 1) AS DOUBLE) AS score FROM l
""")
def verdict_score(spark, sf_dir):
    i = F.col("doc_id")
    verdict = F.when(i % 3 == 0, "Not recommended").when(i % 7 == 0, "Unclear").otherwise("Recommended")
    r = F.concat(F.lit("Match Score: "), (i % 6).cast("string"), F.when(i % 5 == 0, ".5").otherwise(""), F.lit("/5. Verdict: "), verdict)
    return t(spark, sf_dir, "documents").select("doc_id", records.is_recommended(r).alias("promising"), records.score_text(r).alias("score_text"), records.score_value(r).alias("score"))


@query("""
WITH x AS (SELECT o_orderkey, '7. - Acme ' || o_orderpriority || ' | apply by ' || strftime(o_orderdate, '%-d %B %Y') || ' at https://example.com/' || o_custkey || ' now' AS s FROM orders)
SELECT o_orderkey, trim(regexp_replace(trim(split_part(s, '|', 1)), '^\\d+\\.\\s*-\\s*', '')) AS employer, regexp_extract(s, '(?i)(?:apply|last\\s*date|by)\\s*(\\d{1,2}\\s*\\w+\\s*\\d{4})', 1) AS apply_by,
regexp_extract(s, '(https?://[^\\s]+)', 1) AS website FROM x
""")
def deadline_employer(spark, sf_dir):
    s = F.concat(F.lit("7. - Acme "), "o_orderpriority", F.lit(" | apply by "), dates.display(F.col("o_orderdate")), F.lit(" at https://example.com/"), F.col("o_custkey").cast("string"), F.lit(" now"))
    return t(spark, sf_dir, "orders").select("o_orderkey", records.employer(s).alias("employer"), records.deadline(s).alias("apply_by"), records.website(s).alias("website"))


@query("""
WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)(<a\\s[^>]*?href="[^"]*"[^>]*>.*?</a>)', 1) AS l FROM pages),
u AS (SELECT page_id, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS pos FROM a)
SELECT page_id, CAST(pos AS INT) AS pos, regexp_extract(x, '(?is)href="([^"]*)"', 1) AS href, trim(regexp_replace(x, '(?s)<[^>]*>', '', 'g')) AS anchor_text FROM u
""")
def link_extract(spark, sf_dir):
    return extract.anchors(t(spark, sf_dir, "pages"), "page_id", "html")


@query("""
WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '/a.PDF' WHEN 1 THEN 'https://drive.google.com/file/d/abcdefghij' || page_id || '/view' WHEN 2 THEN url || '?pdf=1' ELSE url END AS u FROM pages)
SELECT page_id, CASE WHEN contains(lower(u), 'drive.google.com') OR contains(lower(u), '/uc?id=') THEN 'gdrive' WHEN ends_with(lower(u), '.pdf') THEN 'direct_pdf' WHEN contains(lower(u), 'pdf') THEN 'likely_pdf' ELSE 'unknown' END AS kind,
nullif(regexp_extract(u, '/file/d/([a-zA-Z0-9_-]{10,})', 1), '') AS drive_id FROM u
""")
def link_types(spark, sf_dir):
    i, u = F.col("page_id"), F.col("url")
    url = F.when(i % 4 == 0, F.concat(u, F.lit("/a.PDF"))).when(i % 4 == 1, F.concat(F.lit("https://drive.google.com/file/d/abcdefghij"), i.cast("string"), F.lit("/view"))).when(i % 4 == 2, F.concat(u, F.lit("?pdf=1"))).otherwise(u)
    return t(spark, sf_dir, "pages").select("page_id", records.link_type(url).alias("kind"), records.drive_id(url).alias("drive_id"))


@query()
def page_links(spark, sf_dir):
    return extract.links(t(spark, sf_dir, "pages"), "page_id", "url", "html")


@query("""
SELECT o_orderkey, array_to_string(list_value(strftime(o_orderdate, '%d-%m-%Y'), strftime(o_orderdate, '%d %B %Y'), strftime(o_orderdate, '%Y%m%d'), strftime(o_orderdate, '%b %d, %Y')), '|') AS some, strftime(o_orderdate, '%-d %B %Y') AS display FROM orders
""")
def date_variants(spark, sf_dir):
    every = dates.spellings(F.col("o_orderdate"))
    wanted = [F.date_format("o_orderdate", p) for p in ("dd-MM-yyyy", "dd MMMM yyyy", "yyyyMMdd", "MMM dd, yyyy")]
    some = F.array_join(F.filter(F.array(*wanted), lambda x: F.array_contains(every, x)), "|")
    return t(spark, sf_dir, "orders").select("o_orderkey", some.alias("some"), dates.display(F.col("o_orderdate")).alias("display"))


# Joins


@query("""
WITH n AS (SELECT n_nationkey, n_name, trim(regexp_replace(lower(n_name), '\\s+', ' ', 'g')) AS a FROM nation), s AS (SELECT c_custkey, c_name, lower(c_mktsegment) || ' of ' || lower(n_name) AS label, trim(regexp_replace(regexp_replace(lower(c_mktsegment) || ' of ' || lower(n_name), '[-_()\\[\\].]', ' ', 'g'), '\\s+', ' ', 'g')) AS b FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_nationkey, c_custkey FROM n JOIN s ON contains(b, trim(regexp_replace(regexp_replace(regexp_replace(a, '[-_()\\[\\].]', ' ', 'g'), '\\d{1,2}[-/]\\d{1,2}|\\d{4}', '', 'g'), '\\s+', ' ', 'g')))
""")
def fuzzy_name_join(spark, sf_dir):
    nation, customer = t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), t(spark, sf_dir, "customer")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat(F.lower("c_mktsegment"), F.lit(" of "), F.lower("n_name")).alias("label"))
    return match.name_join(nation, named, "n_name", "label").select("n_nationkey", "c_custkey")


@query()
def fuzzy_first_match(spark, sf_dir):
    """Each part with the first one whose name is near enough to its own."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name")
    other = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("first_partkey"), F.col("p_name").alias("first_name"), F.col("p_size").alias("size"))
    found = match.fuzzy_first(p, other, "p_name", "first_name", [F.desc("size"), F.col("first_partkey")])
    return found.select("p_partkey", "first_partkey", F.round("ratio", 9).alias("ratio"))


@query("""
SELECT l_orderkey, l_linenumber, p_name, p_name IS NULL AS needs_fallback FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey
""")
def attach_profile(spark, sf_dir):
    parts = t(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return match.with_default(lines, parts, "l_partkey", "p_name", F.lit(None).cast("string")).select("l_orderkey", "l_linenumber", "p_name", "needs_fallback")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def orphans(spark, sf_dir):
    good = t(spark, sf_dir, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return joins.without_partner(t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), good, "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_difference(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id").subtract(t(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT event_id, CAST(event_id % 8 AS INT) AS attempt, least(10.0 * pow(2, event_id % 8), 300.0) AS pause FROM events")
def backoff_ladder(spark, sf_dir):
    """The pause before each event's next attempt, by the number of attempts that it had."""
    attempt = F.col("event_id") % 8
    return t(spark, sf_dir, "events").select("event_id", attempt.cast("int").alias("attempt"), records.backoff(10, attempt, 300).alias("pause"))


# Boxes, messages and keys

BOX = "l_orderkey, l_linenumber, CAST(l_partkey % 400 AS DOUBLE) AS w, CAST(l_suppkey % 90 + l_quantity AS DOUBLE) AS h, CAST(l_partkey % 700 AS DOUBLE) AS y"


def box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h, y = F.col("l_partkey") % 400, F.col("l_suppkey") % 90 + F.col("l_quantity"), F.col("l_partkey") % 700
    return t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", w.cast("double").alias("w"), h.cast("double").alias("h"), y.cast("double").alias("y"))


@query(f"""
SELECT l_orderkey, l_linenumber, coalesce(w > 80 AND h > 40 AND w * h > 5000 AND w / nullif(h, 0) > 0.1 AND w / nullif(h, 0) < 10, false) AS block,
coalesce(w > 100 AND h > 60 AND w < 0.95 * 390 AND w * h > 12000 AND w / nullif(h, 0) > 0.25 AND w / nullif(h, 0) < 4 AND y > 300, false) AS draft,
CASE WHEN w < 50 OR h < 30 THEN 'tiny' WHEN y / 700 < 0.12 THEN 'graphic' WHEN l_linenumber > 4 THEN 'text' ELSE 'ok' END AS class FROM (SELECT {BOX} FROM lineitem)
""")
def box_filters(spark, sf_dir):
    w, h, y = F.col("w"), F.col("h"), F.col("y")
    false = F.lit(False)
    block, draft = F.coalesce(boxes.is_block(w, h, w * h), false), F.coalesce(boxes.is_draft_block(w, h, y, F.lit(390)), false)
    return box_rows(spark, sf_dir).select("l_orderkey", "l_linenumber", block.alias("block"), draft.alias("draft"), boxes.crop_class(w, h, y / 700, F.col("l_linenumber") > 4).alias("class"))


@query(f"SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY y, w, l_linenumber) AS INT) AS block FROM (SELECT {BOX} FROM lineitem)")
def box_order(spark, sf_dir):
    return boxes.reading_order(box_rows(spark, sf_dir), ["l_orderkey"], x="w", y="y", ties=("l_linenumber",)).select("l_orderkey", "l_linenumber", "block")


@query("""
WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS x, value FROM events),
f AS (SELECT user_id, x, (value - min(value) OVER u) / (max(value) OVER u - min(value) OVER u + 1e-5) < 0.3 AS gap, max(x) OVER u + 1 AS width FROM p WINDOW u AS (PARTITION BY user_id)),
g AS (SELECT user_id, width, min(x) AS a, max(x) + 1 AS b FROM (SELECT user_id, x, width, x - row_number() OVER (PARTITION BY user_id ORDER BY x) AS run FROM f WHERE gap) GROUP BY user_id, width, run HAVING count(*) >= 2 AND max(x) + 1 < width),
c AS (SELECT user_id, a, b FROM g UNION ALL SELECT user_id, max(width), max(width) FROM f GROUP BY user_id),
l AS (SELECT user_id, coalesce(lag(b) OVER (PARTITION BY user_id ORDER BY a, b), 0) AS x0, a AS x1 FROM c)
SELECT user_id, CAST(x0 AS INT) AS x0, CAST(x1 AS INT) AS x1 FROM l WHERE x1 - x0 >= 3
""")
def column_bounds(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    profile = t(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).alias("x"), "value")
    return boxes.columns(profile, ["user_id"], gap=0.3, gap_width=2, column_width=3)


@query("""
SELECT o_orderkey, md5('FILE: ' || o_orderstatus || chr(10) || '---CONTENT_START---' || chr(10) || o_orderpriority || chr(10) || '---CONTENT_END---' || chr(10) || chr(10) || 'FILE: b' || chr(10) || '---CONTENT_START---' || chr(10) || 'x' || chr(10) || '---CONTENT_END---' || chr(10)) AS prompt_md5 FROM orders
""")
def batch_prompts(spark, sf_dir):
    prompt = messages.batch_prompt(F.array("o_orderstatus", F.lit("b")), F.array("o_orderpriority", F.lit("x")))
    return t(spark, sf_dir, "orders").select("o_orderkey", F.md5(prompt).alias("prompt_md5"))


@query("""
SELECT o_orderkey, array_to_string(['<b>📢 New Job Alert</b>', '<b>🏢 Acme Power Corporation</b>', '<code>Acme Power Corporation &#124; apply by ' || d || ' https://example&#46;com/' || o_orderkey || '</code>',
'<b>🗓 Apply before: ' || d || '</b>', '<b>🌐</b> https://example.com/' || o_orderkey, '<b>🎯 Similarity:</b> 0.35 | <b>Score:</b> 4/5', '<b>📄 Resume:</b> <code>dynamic_resume_hybrid&#46;txt</code>',
'<b>💼 Resume tip:</b> Tailor resume to match specific keywords from job description.', '<i>Shortlisted on ' || d || '</i>'], chr(10)) AS message FROM (SELECT o_orderkey, strftime(o_orderdate, '%-d %B %Y') AS d FROM orders)
""")
def job_messages(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    text = F.concat(F.lit("Acme Power Corporation | apply by "), dates.display(F.col("o_orderdate")), F.lit(" https://example.com/"), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", messages.job_message(text, F.lit(0.35), F.lit(4), F.col("o_orderdate")).alias("message"))


@query()
def key_rotation(spark, sf_dir):
    asked = t(spark, sf_dir, "events").select("event_type", "event_id", "ts", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
    return keys.assign(asked, "event_type", ["ts", "event_id"], "s", ["a", "b", "c"]).select("event_id", "label")


from quern.plans import more, pieces, scans, streams  # noqa: E402, F401  (they register their queries)
