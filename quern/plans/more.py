"""Further catalogue queries: positional, prefix and locating joins, orders, arrays, maps, JSON, hashes and dates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import dates, records
from quern.functions import text as T
from quern.operators import dedup, joins
from quern.plans.catalogue import query, t
from quern.sources import files


@query("""
SELECT a.conv_id, a.turn, a.role AS left_role, b.role AS right_role FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id + 1 AND b.turn = a.turn
""")
def zip_join(spark, sf_dir):
    c = t(spark, sf_dir, "conversations")
    left = c.select("conv_id", "turn", F.col("role").alias("left_role"))
    return joins.zipped(left, c.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("role").alias("right_role")), ["conv_id", "turn"])


@query("SELECT a.source AS issue, count(*) AS files FROM (SELECT DISTINCT source FROM documents) a JOIN documents b ON starts_with(b.source || '_p1', a.source || '_p') GROUP BY 1")
def issue_files(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    files = d.select(T.issue_prefix(F.concat("source", F.lit("_p1"))).alias("issue"))
    return d.select(F.col("source").alias("issue")).distinct().join(files.groupBy("issue").agg(F.count(F.lit(1)).alias("files")), "issue")


@query("SELECT l_partkey, min(l_orderkey) AS first_order, arg_min(l_linenumber, l_orderkey * 100 + l_linenumber) AS first_line FROM lineitem GROUP BY l_partkey")
def locate_first(spark, sf_dir):
    found = joins.first_place(t(spark, sf_dir, "lineitem"), ["l_partkey"], ["l_orderkey", "l_linenumber"])
    return found.withColumnsRenamed({"l_orderkey": "first_order", "l_linenumber": "first_line"})


@query("""
WITH r AS (SELECT o_orderkey, o_custkey, o_orderpriority LIKE '1%' AS urgent FROM orders)
SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY urgent DESC, CASE WHEN urgent THEN -o_orderkey ELSE o_orderkey END) AS INT) AS place FROM r
""")
def priority_order(spark, sf_dir):
    r = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.startswith("o_orderpriority", F.lit("1")).alias("urgent"))
    return joins.front_inserts(r, ["o_custkey"], F.col("urgent"), "o_orderkey").select("o_orderkey", "place")


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS most FROM events")
def running_max(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t(spark, sf_dir, "events").select("event_id", F.max("value").over(w).alias("most"))


@query("""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, array_to_string(list_slice(w, 1, 5), ' ') AS head, len(list_filter(w, lambda x: length(x) > 8)) > 0 AS any_long, len(list_filter(w, lambda x: length(x) < 1)) = 0 AS none_empty,
CAST(len(list_distinct(list_transform(w, lambda x: lower(x)))) AS INT) AS kinds FROM w
""")
def array_functions(spark, sf_dir):
    # words are a column of their own: written into each use, the text would be split once for each; a small file is one task
    rows, w = t(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id").select("doc_id", T.words(F.col("text")).alias("w")), F.col("w")
    kinds = F.size(F.array_distinct(F.transform(w, F.lower)))
    return rows.select("doc_id", F.array_join(F.slice(w, 1, 5), " ").alias("head"), F.exists(w, lambda x: F.length(x) > 8).alias("any_long"), F.forall(w, lambda x: F.length(x) > 0).alias("none_empty"), kinds.alias("kinds"))


@query("SELECT doc_id, coalesce(map_from_entries([{k: 'en', v: 1}, {k: 'fr', v: 2}])[lang], 0) AS code, md5(text) AS text_md5, '{\"id\":' || doc_id || ',\"lang\":\"' || lang || '\"}' AS as_json FROM documents")
def maps_json_hashes(spark, sf_dir):
    code = F.coalesce(F.try_element_at(F.create_map(F.lit("en"), F.lit(1), F.lit("fr"), F.lit(2)), F.col("lang")), F.lit(0))
    return t(spark, sf_dir, "documents").select("doc_id", code.alias("code"), F.md5("text").alias("text_md5"), F.to_json(F.struct(F.col("doc_id").alias("id"), "lang")).alias("as_json"))


@query("""
SELECT event_id, CASE WHEN date_trunc('day', ts) + INTERVAL '6 hours 30 minutes' > ts THEN date_trunc('day', ts) + INTERVAL '6 hours 30 minutes' ELSE date_trunc('day', ts) + INTERVAL '30 hours 30 minutes' END AS next_run,
CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN user_id ELSE 0 END AS used, CAST(ts AS DATE) AS day FROM events
""")
def daily_schedule(spark, sf_dir):
    ts, day = F.col("ts"), F.to_date("ts")
    return t(spark, sf_dir, "events").select("event_id", dates.next_daily(ts, 6, 30).alias("next_run"), dates.reset_daily(F.col("user_id"), day, F.lit("2024-01-15").cast("date")).cast("long").alias("used"), day.alias("day"))


@query("""
SELECT page_id, contains(lower(html), 'checking your browser') OR contains(lower(html), 'please wait') OR contains(lower(html), 'var _cf_chl_ctx') OR contains(lower(html), 'ddos') OR contains(lower(html), 'just a moment') AS challenge,
length(html) AS size FROM pages
""")
def challenge_pages(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", records.is_challenge(F.col("html")).alias("challenge"), F.length("html").cast("long").alias("size"))


@query("SELECT DISTINCT ON (user_id) user_id, event_type, event_id FROM events ORDER BY user_id, ts, event_id")
def ordered_distinct(spark, sf_dir):
    return dedup.first_of(t(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT o_orderkey, '{\"page\": ' || o_orderkey || ', \"date\": ' || strftime(o_orderdate, '%d-%m-%Y') || '}' AS url FROM orders")
def templated_urls(spark, sf_dir):
    pattern = F.concat(F.lit('{"page": '), F.col("o_orderkey").cast("string"), F.lit(', "date": {date}}'))
    rows = t(spark, sf_dir, "orders").withColumn("pattern", pattern)
    return files.templated_urls(rows, "pattern", F.col("o_orderdate"), F.lit("dd-MM-yyyy")).select("o_orderkey", "url")


@query("SELECT c_custkey, least(greatest(CASE WHEN c_custkey % 3000 > 2000 THEN least(c_nationkey * 20, 200) ELSE c_nationkey * 20 END, 150), 300) AS dpi, least(1.0, 768 / (c_custkey + 1)::DOUBLE) AS scale FROM customer")
def page_resolution(spark, sf_dir):
    from quern.functions import boxes

    c = t(spark, sf_dir, "customer")
    return c.select("c_custkey", records.dpi(F.col("c_custkey") % 3000, F.lit(0), F.col("c_nationkey") * 20).alias("dpi"), boxes.reader_scale(F.col("c_custkey") + 1).alias("scale"))
