"""Dates and durations as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of a date, in the order in which they are tried.
DATE_SPELLINGS = (
    "dd-MM-yyyy", "dd/MM/yyyy", "dd MMMM yyyy", "dd MMM yyyy", "dd-MM-yy", "dd/MM/yy", "dd MMMM, yyyy", "dd MMM, yyyy", "yyyy-MM-dd", "yyyyMMdd",
    "ddMMyyyy", "dd-MMM-yyyy", "dd.MM.yyyy", "MMMM dd, yyyy", "MMM dd, yyyy", "MMMM dd", "MMM dd", "dd MMMM", "dd MMM",
)


def spellings(day: Column, first: Sequence[str] = ()) -> Column:
    """The distinct spellings of a date, own ones first, in order."""
    return F.array_distinct(F.array(*[F.date_format(day, p) for p in (*first, *DATE_SPELLINGS)]))


def mentions_date(text: Column, day: Column) -> Column:
    """Whether a text names a day as digits with any common separator or with its month's name, zero-padded or not."""
    d, m = F.dayofmonth(day).cast("string"), F.month(day).cast("string")
    digits = F.concat(F.lit(r"(?<!\d)0?"), d, F.lit(r"[-/. ]0?"), m, F.lit(r"[-/. ](?:"), F.date_format(day, "yyyy"), F.lit("|"), F.date_format(day, "yy"), F.lit(r")(?!\d)"))
    named = F.concat(F.lit(r"(?i)(?<!\d)0?"), d, F.lit(r"(?:st|nd|rd|th)?\s+"), F.date_format(day, "MMM"), F.lit(r"[a-z]*"))
    iso = F.contains(text, F.date_format(day, "yyyy-MM-dd")) | F.contains(text, F.date_format(day, "yyyyMMdd"))
    return F.regexp(text, digits) | F.regexp(text, named) | iso


def iso_or_epoch(c: Column) -> Column:
    """A timestamp from ISO text; the epoch where it cannot be read."""
    return F.coalesce(F.try_to_timestamp(c), F.timestamp_seconds(F.lit(0)))


def display(ts: Column) -> Column:
    return F.date_format(ts, "d MMMM yyyy")


def reset_daily(count: Column, stored: Column, today: Column) -> Column:
    """A counter that starts again when its stored day is not today."""
    return F.when(stored == today, count).otherwise(0)


def next_daily(now: Column, hour: int, minute: int) -> Column:
    """The next time, strictly after now, that the clock shows hour:minute."""
    today = F.date_trunc("day", now) + F.make_dt_interval(F.lit(0), F.lit(hour), F.lit(minute), F.lit(0))
    return F.when(today > now, today).otherwise(today + F.make_dt_interval(F.lit(1)))


def duration(seconds: Column) -> Column:
    """"1h 2m 3s", without leading parts that are zero."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))
