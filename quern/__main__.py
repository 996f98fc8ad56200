"""Command line: `python -m quern history|clear-history|shortlist|notify|windows|dedup ...` over Parquet folders."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quern.operators import dedup, match, notify, windows
from quern.operators.state import StateTable


def arguments(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quern")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("history", help="the newest shortlisted jobs")
    p.add_argument("state")
    p.add_argument("--limit", type=int, default=20)
    p = sub.add_parser("clear-history", help="forget what was shortlisted")
    p.add_argument("state")
    p = sub.add_parser("shortlist", help="best profile for each job, over the threshold, without known jobs")
    p.add_argument("jobs")
    p.add_argument("profiles")
    p.add_argument("out")
    p.add_argument("--state")
    p.add_argument("--threshold", type=float, default=match.THRESHOLD)
    p.add_argument("--force", action="store_true", help="known jobs as well")
    p = sub.add_parser("notify", help="hand over what was shortlisted since the last time")
    p.add_argument("state")
    p.add_argument("sent", help="state table of watermarks")
    p.add_argument("--receiver", default="quern.__main__:printed", help="module:function of (id, message)")
    p.add_argument("--since", help="from this day (YYYY-MM-DD) on, whatever the watermark")
    p.add_argument("--force", action="store_true", help="all, whatever the watermark")
    p.add_argument("--dry-run", action="store_true", help="hand nothing over and move no watermark")
    p.add_argument("--pace", type=float, default=1.5, help="seconds between two messages of a task")
    p = sub.add_parser("windows", help="overlapping word windows")
    p.add_argument("pages")
    p.add_argument("out")
    p.add_argument("--width", type=int, default=windows.WIDTH)
    p.add_argument("--overlap", type=int, default=windows.OVERLAP)
    p = sub.add_parser("dedup", help="fuzzy distinct within an issue")
    p.add_argument("listings")
    p.add_argument("out")
    p.add_argument("--ratio", type=float, default=dedup.DUPLICATE_RATIO)
    return parser.parse_args(args)


def printed(name: str, message: str) -> None:
    print(f"{name}: {message}")


def notified(spark: SparkSession, a: argparse.Namespace) -> None:
    """Prints how many rows were delivered and how many failed, and stores the next watermark unless nothing moves it on."""
    jobs, marks = StateTable(spark, a.state).read(), StateTable(spark, a.sent)
    if jobs is None:
        return
    last = marks.read()
    watermark = None if last is None else last.agg(F.max("watermark")).first()[0]
    module, _, function = a.receiver.partition(":")
    send = getattr(importlib.import_module(module), function)
    since = F.lit(a.since).cast("timestamp") if a.since else None
    rows = notify.pending(jobs.withColumn("ts", F.col("shortlisted_at").cast("timestamp")), "ts", F.lit(watermark).cast("timestamp"), since, a.force)
    outcomes = notify.delivered(rows.select(F.col("job_id").cast("string").alias("id"), F.col("job_id").cast("string").alias("message"), "ts"), send, a.dry_run, pace_s=a.pace)
    counts = outcomes.agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed")).first()
    print(f"{counts.ok} delivered, {counts.failed} failed")
    moved = notify.next_watermark(outcomes, a.dry_run).where("watermark is not null").withColumn("name", F.lit("notify"))
    if not moved.isEmpty():
        marks.upsert(moved, ["name"], [F.desc("watermark")])


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = arguments(args)
    spark = spark or SparkSession.builder.appName("quern").getOrCreate()
    if a.command == "history":
        table = StateTable(spark, a.state).read()
        if table is not None:
            table.orderBy(F.desc("shortlisted_at"), "job_id").limit(a.limit).show(a.limit, truncate=60)
    elif a.command == "clear-history":
        StateTable(spark, a.state).clear()
    elif a.command == "windows":
        windows.word_windows(spark.read.parquet(a.pages), "text", a.width, a.overlap).write.parquet(a.out)
    elif a.command == "dedup":
        dedup.fuzzy_distinct(spark.read.parquet(a.listings), ["issue"], "line_no", "text", a.ratio).write.parquet(a.out)
    elif a.command == "notify":
        notified(spark, a)
    else:
        found = match.shortlist(match.best_profile(spark.read.parquet(a.jobs), "embedding", spark.read.parquet(a.profiles)), a.threshold)
        if a.state:
            history = StateTable(spark, a.state)
            if (known := history.read()) is not None and not a.force:
                found = match.only_new(found, known, "job_id", [F.desc("similarity")])
        found.drop("embedding").write.parquet(a.out)
        if a.state:
            new = spark.read.parquet(a.out).withColumn("shortlisted_at", F.current_timestamp())
            history.upsert(new, ["job_id"], [F.desc("shortlisted_at")])


if __name__ == "__main__":
    main()
