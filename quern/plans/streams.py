"""Catalogue queries that run as streams, over paged sources, along links and on rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import scratch
from quern.functions import records
from quern.operators import notify, raster, ratelimit, redo, resolve
from quern.plans.catalogue import query, t
from quern.sources import named, paged
from quern.streaming import delivery, incremental, stateful


#: Tasks that hand orders over side by side.
SENDERS = 48


def ran(stream: DataFrame, label: str) -> DataFrame:
    """All that the stream gives for what there is now."""
    spark, out = stream.sparkSession, scratch.path(stream.sparkSession, label)
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch.path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def in_files(df: DataFrame, label: str, parts: list, files_at_once: int = 1000) -> DataFrame:
    """A stream of df's rows, those of each condition in micro-batches after those of the ones before."""
    spark, path = df.sparkSession, scratch.path(df.sparkSession, label)
    df = scratch.stored(df, f"{label}-rows")  # one task writes a part, so it should have nothing else to do
    for part in parts:
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


@query("SELECT CAST(conv_id AS VARCHAR) AS page, count(*) AS blocks, conv_id % 3 <> 0 AS complete FROM conversations GROUP BY conv_id")
def stream_pages(spark, sf_dir):
    """Turns as blocks of pages; every third page waits for one that never comes, and is told as incomplete when its time is over."""
    c = t(spark, sf_dir, "conversations")
    sizes = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn") * 60)
    rows = c.join(sizes, "conv_id").select(F.col("conv_id").cast("string").alias("page"), F.col("turn").cast("long").alias("block"), (F.col("n") + (F.col("conv_id") % 3 == 0).cast("int")).alias("expected"), ts.alias("ts"))
    late = [spark.range(1).select(F.lit(f"end {k}").alias("page"), F.lit(0).cast("long").alias("block"), F.lit(1).cast("long").alias("expected"), F.timestamp_seconds(F.lit(1_800_000_000 + k)).alias("ts")) for k in range(2)]
    every = rows.unionByName(late[0]).unionByName(late[1])
    end = F.startswith("page", F.lit("end"))
    stream = in_files(every, "blocks", [~end & (F.col("block") % 2 == 0), ~end & (F.col("block") % 2 != 0), F.col("page") == "end 0", F.col("page") == "end 1"], 1)
    found = ran(stateful.page_completions(stream, "ts", "1 hour", keep_ms=3_600_000), "pages")
    return found.where("not startswith(page, 'end')")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
f AS (SELECT user_id, event_id, rn, ts + INTERVAL 24 HOUR AS until, true AS passed FROM e WHERE rn = 1
  UNION ALL SELECT e.user_id, e.event_id, e.rn, CASE WHEN e.ts >= f.until THEN e.ts + INTERVAL 24 HOUR ELSE f.until END, e.ts >= f.until FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
SELECT user_id AS key, event_id FROM f WHERE passed
""")
def stream_skips(spark, sf_dir):
    """A user's event is skipped within a day of the last that was not."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.expr("timestamp '2024-01-15 00:00:00'")
    return ran(stateful.skip_list(in_files(e, "events", [early, ~early], 1), "user_id", "ts", "event_id", "1 hour", 86_400_000), "skips")


def unreliable(name: str, message: str) -> None:
    """A receiver that fails a row by its id: one in 97 always; it stands for a service that is not there."""
    if int(name) % 97 == 0:
        raise ConnectionError("no answer")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey % 97 <> 0 AS ok, CASE WHEN o_orderkey % 97 = 0 THEN 3 ELSE 1 END AS attempts, CASE WHEN o_orderkey % 97 = 0 THEN 'ConnectionError: no answer' END AS error FROM orders
""")
def delivered_orders(spark, sf_dir):
    """Every order handed to a receiver, with its outcome."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("message"), F.to_timestamp("o_orderdate").alias("ts"))
    path, inbox = scratch.path(spark, "outcomes"), scratch.path(spark, "orders")
    o.write.parquet(inbox)
    delivery.deliver(spark.readStream.schema(o.schema).parquet(inbox), path, scratch.path(spark, "checkpoint"), unreliable, senders=SENDERS, pause_s=0.0, pace_s=0.0)
    return delivery.outcomes(spark, path).select("id", "ok", "attempts", "error")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey % 97 <> 0 AS ok, CASE WHEN o_orderkey % 97 = 0 THEN 2 ELSE 1 END AS attempts, (SELECT min(o_orderdate)::TIMESTAMP - INTERVAL 1 MICROSECOND FROM orders WHERE o_orderdate > DATE '1995-06-30' AND o_orderkey % 97 = 0) AS next_watermark
FROM orders WHERE o_orderdate > DATE '1995-06-30'
""")
def notified_orders(spark, sf_dir):
    """Orders after a watermark handed over in batch, and the watermark that stays before the first failure."""
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("message"), F.to_timestamp("o_orderdate").alias("ts"))
    new = notify.pending(o, "ts", F.lit("1995-06-30").cast("timestamp"))
    found = notify.delivered(new, unreliable, attempts=2, pause_s=0.0, pace_s=0.0)
    mark = notify.next_watermark(found).first().watermark
    return found.select("id", "ok", "attempts", F.lit(mark).cast("timestamp_ntz").alias("next_watermark"))


@query("""
WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, value > 80 AS throttled, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
f AS (
  SELECT user_id, NULL::BIGINT AS event_id, 0::BIGINT AS rn, us AS refilled, -1::BIGINT AS day, 5.0::DOUBLE AS tokens, 0 AS used, 0::BIGINT AS blocked, '' AS decision FROM e WHERE rn = 1
  UNION ALL
  SELECT user_id, event_id, rn, CASE WHEN decision IN ('cooldown', 'quota') THEN refilled ELSE us END, us // 86400000000,
    CASE WHEN decision IN ('cooldown', 'quota') THEN tokens WHEN decision = 'allowed' AND NOT throttled THEN filled - 1 ELSE filled END,
    CASE WHEN decision = 'allowed' AND NOT throttled THEN used + 1 ELSE used END, CASE WHEN decision = 'allowed' AND throttled THEN us + 86400000000 ELSE blocked END, decision
  FROM (SELECT *, CASE WHEN us < blocked THEN 'cooldown' WHEN used >= 20 THEN 'quota' WHEN filled < 1 THEN 'tokens' ELSE 'allowed' END AS decision
    FROM (SELECT e.user_id, e.event_id, e.rn, e.us, e.throttled, f.refilled, f.tokens, f.blocked, CASE WHEN f.day = e.us // 86400000000 THEN f.used ELSE 0 END AS used,
      least(5.0::DOUBLE, f.tokens + (e.us / 1e6::DOUBLE - f.refilled / 1e6::DOUBLE) * 15 / 60) AS filled FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)))
SELECT user_id, event_id, decision FROM f WHERE rn > 0
""")
def cooled_bucket(spark, sf_dir):
    """A user whose call is answered by "too many requests" waits for a day."""
    e = t(spark, sf_dir, "events").select("user_id", "event_id", "ts", (F.col("value") > 80).alias("throttled"))
    found = ratelimit.token_bucket(e, "user_id", "ts", "event_id", ratelimit.Limits(cooldown_s=86_400.0), throttled="throttled")
    return found.select("user_id", "event_id", "decision")


@query("SELECT source, doc_id, CASE WHEN source IN (SELECT source FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source HAVING count(*) FILTER (NOT coalesce(quality = 1, false)) > 0) THEN 2 ELSE 1 END AS run, md5(text) AS text_md5 FROM documents")
def strict_redo(spark, sf_dir):
    """A first run leaves sources open whose documents it did not finish; a second computes those sources whole, a third nothing."""
    d, path = t(spark, sf_dir, "documents").select("source", "doc_id", "text"), scratch.path(spark, "outputs")
    good = t(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("good"))
    texts = d.select("doc_id", F.md5("text").alias("text_md5"))
    empty = spark.createDataFrame([], "source string, doc_id long, run int, text_md5 string")
    ok = lambda done: F.col("text_md5").isNotNull()

    def computed(run: int):
        def compute(rows: DataFrame) -> DataFrame:
            made = rows.join(texts, "doc_id").withColumn("run", F.lit(run))
            # what the first run could not do has no result
            return made.join(good, "doc_id", "left").withColumn("text_md5", F.when(F.col("good") | F.lit(run > 1), F.col("text_md5"))) if run else made

        return compute

    ran = [redo.redo(d.select("source", "doc_id"), path, computed(k), "source", "doc_id", ok, empty) for k in (1, 2, 3)]
    assert ran[2] == 0
    return redo.outputs(spark, path, empty)


def recorded(spark, sf_dir) -> str:
    """The table of pages as a paged service would show it, 50 items a page."""
    path, p = scratch.path(spark, "service"), t(spark, sf_dir, "pages")
    number = (F.floor(F.col("page_id") / 50) + 1).cast("int")
    named.write_json_array(p.select("page_id", "url", F.md5("html").alias("digest")), path, F.format_string("page_%d.json", number))
    return path


@query("SELECT page_id, url, md5(html) AS digest FROM pages")
def paged_batch(spark, sf_dir):
    paged.register(spark)
    return spark.read.format("paged").schema("page_id long, url string, digest string").option("cache", scratch.path(spark, "cache")).load(recorded(spark, sf_dir))


@query("SELECT page_id, url, md5(html) AS digest FROM pages")
def paged_stream(spark, sf_dir):
    paged.register(spark)
    stream = spark.readStream.format("paged").schema("page_id long, url string, digest string").load(recorded(spark, sf_dir))
    return ran(stream, "paged")


LINKED = """
n AS (SELECT count(*) AS n FROM pages), p AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS i, 'https://host.example/' || page_id || CASE page_id % 11 WHEN 0 THEN '/paper.pdf' WHEN 5 THEN '/uc?id=abcdefghij' || page_id ELSE '' END AS url FROM pages),
l AS (SELECT a.url, b.url AS target FROM p a CROSS JOIN n JOIN p b ON b.i = (a.i * 7 + 3) % n.n UNION ALL SELECT a.url, b.url FROM p a CROSS JOIN n JOIN p b ON b.i = (a.i + 1) % n.n)
"""


@query(f"""
WITH RECURSIVE {LINKED}, r AS (SELECT page_id AS root, url, 0 AS hops FROM p UNION SELECT r.root, l.target, r.hops + 1 FROM r JOIN l ON l.url = r.url WHERE r.hops < 3),
m AS (SELECT root, url, min(hops) AS hops, CASE WHEN ends_with(url, '.pdf') THEN 0 WHEN contains(url, '/uc?id=') THEN 1 END AS rank FROM r GROUP BY root, url),
b AS (SELECT * FROM m WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY root ORDER BY rank, hops, url) = 1)
SELECT page_id AS root, b.url, b.hops, b.rank FROM p LEFT JOIN b ON b.root = page_id
""")
def resolved_links(spark, sf_dir):
    """Pages with two links each, in circles: for each page the document that at most three links lead to, direct ones before
    those of a drive."""
    from quern.operators.ranks import ranked

    i = F.col("page_id")
    url = F.concat(F.lit("https://host.example/"), i.cast("string"), F.when(i % 11 == 0, "/paper.pdf").when(i % 11 == 5, F.concat(F.lit("/uc?id=abcdefghij"), i.cast("string"))).otherwise(""))
    p = ranked(t(spark, sf_dir, "pages").select("page_id"), [], [i], "_rank").select("page_id", (F.col("_rank") - 1).alias("i"), url.alias("url"))
    p = scratch.stored(p, "pages")
    n = p.count()
    to = p.select(F.col("i").alias("j"), F.col("url").alias("target"))
    links = p.select("url", F.explode(F.array((F.col("i") * 7 + 3) % n, (F.col("i") + 1) % n)).alias("j")).join(to, "j")
    kind = records.link_type(F.col("url"))
    rank = F.when(kind == "direct_pdf", 0).when(kind == "gdrive", 1)
    return resolve.resolved(p.select(F.col("page_id").alias("root"), "url"), links, rank, 3)


CELLS = "SELECT DISTINCT user_id % 10 AS image, user_id // 10 AS y, CAST(extract('hour' FROM ts) + 24 * (extract('day' FROM ts) % 3) AS BIGINT) AS x FROM events WHERE value > 60"


@query(f"""
WITH RECURSIVE c AS MATERIALIZED ({CELLS}), k AS MATERIALIZED (SELECT image, x, y, image * 100000000 + y * 1000 + x AS id FROM c),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON b.image = a.image AND b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1),
r(id, name) AS (SELECT id, id FROM k UNION SELECT e.b, r.name FROM r JOIN e ON e.a = r.id WHERE r.name < e.b),
m AS (SELECT id, min(name) AS name FROM r GROUP BY id)
SELECT image, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, count(*) AS area FROM k JOIN m USING (id) GROUP BY image, name
""")
def raster_blocks(spark, sf_dir):
    """Events as cells of ten rasters, users by hours of three days, and their connected blocks."""
    e = t(spark, sf_dir, "events").where("value > 60")
    x = F.hour("ts") + 24 * (F.dayofmonth("ts") % 3)
    cells = e.select((F.col("user_id") % 10).alias("image"), F.floor(F.col("user_id") / 10).alias("y"), x.cast("long").alias("x"))
    return raster.blocks(cells, ["image"])


@query("""
WITH h AS (SELECT user_id % 50 AS image, CAST(floor(value) AS BIGINT) % 256 AS level, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2),
s AS (SELECT *, sum(n) OVER u AS n0, sum(n * level) OVER u AS s0, sum(n) OVER w AS nn, sum(n * level) OVER w AS ss FROM h WINDOW u AS (PARTITION BY image ORDER BY level), w AS (PARTITION BY image)),
b AS (SELECT *, coalesce(round(n0 / nn * ((nn - n0) / nn) * pow(s0 / n0 - (ss - s0) / nullif(nn - n0, 0), 2), 9), 0) AS v FROM s)
SELECT image, level AS threshold, round(n0 / nn, 9) AS density, n0 / nn < 0.12 AS graphic FROM b QUALIFY row_number() OVER (PARTITION BY image ORDER BY v DESC, level) = 1
""")
def otsu_density(spark, sf_dir):
    """Events as pixels of fifty images: the threshold that parts dark from light, and the share of dark ones."""
    e = t(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("image"), (F.floor("value") % 256).alias("level"))
    found = raster.otsu(e.groupBy("image", "level").agg(F.count(F.lit(1)).alias("n")), ["image"])
    return found.select("image", "threshold", F.round("density", 9).alias("density"), raster.is_graphic(F.col("density")).alias("graphic"))


@query("SELECT event_id, count(*) AS times FROM events GROUP BY event_id")
def archived_events(spark, sf_dir):
    """Files of events taken once each by a stream that moves what it has taken, in two runs."""
    e, src, old, out, cp = t(spark, sf_dir, "events").select("event_id", "user_id"), *(scratch.path(spark, x) for x in ("inbox", "archive", "taken", "checkpoint"))
    for k in range(2):
        e.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == k).write.mode("append").parquet(src)
        incremental.archiving_stream(spark, src, e.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), old).writeStream.format("parquet").option("path", out).option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).alias("times"))
