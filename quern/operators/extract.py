"""Structured records from model responses and web pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quern import scratch
from quern.functions import text as T

RESPONSE = "struct<files: array<struct<filename: string, concise_listings: array<string>, full_descriptions: array<string>>>>"


def response_text(fields: list[Column]) -> Column:
    """The first non-empty of several alternative fields."""
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in fields])


def parsed(df: DataFrame, response: str) -> DataFrame:
    """df with _files, the files array of a response, by the first of these that parses: what lies between the outermost braces of
    the unfenced text, the object around its "files" key, the whole text. Null if none does.

    Each step is a column of its own, which Spark does not fold into those that use it several times. As one expression the
    text would be stripped some hundreds of times a row. A filter on _files would fold them all into itself, so store it first."""
    steps = df.withColumn("_stripped", T.strip(F.col(response))).withColumn("_raw", T.without_fence(F.col("_stripped")))
    steps = steps.withColumn("_at", F.locate('"files"', "_raw")).withColumn("_before", F.substr("_raw", F.lit(1), F.col("_at") - 1))
    opening = F.length("_before") - F.locate("{", F.reverse("_before")) + 1
    held = (F.col("_at") > 0) & F.contains("_before", F.lit("{"))
    steps = steps.withColumns({"_outer": T.outer_braces(F.col("_raw")), "_opened": F.when(held, F.substr("_raw", opening))})
    steps = steps.withColumn("_around", T.outer_braces(F.col("_opened")))
    read = lambda c: F.from_json(F.when(F.try_parse_json(F.col(c)).isNotNull(), F.col(c)), RESPONSE)["files"]
    return steps.select(*df.columns, F.coalesce(read("_outer"), read("_around"), read("_raw")).alias("_files"))


def json_listings(df: DataFrame, key: str, response: str) -> DataFrame:
    """(key, filename, line_no, listing) of responses that parse; defaults are no name and no listings."""
    return _entries(parsed(df.select(key, response), response), key)


def _entries(df: DataFrame, key: str) -> DataFrame:
    files = df.select(key, F.inline(F.coalesce("_files", F.expr(f"cast(array() as {RESPONSE[13:-1]})"))))
    return files.select(key, F.coalesce("filename", F.lit("")).alias("filename"), F.posexplode(F.coalesce("concise_listings", F.array().cast("array<string>"))).alias("line_no", "listing"))


def text_listings(df: DataFrame, key: str, response: str) -> DataFrame:
    """(key, filename, line_no, listing) by lines: a line "FILE: x" opens x, lines that start with "- " are its listings.

    Lines before the first mark belong to no file and are left out, as are files without listings."""
    lines = df.select(key, F.posexplode(F.split(F.col(response), "\n")).alias("line_no", "_l")).withColumn("_l", T.strip(F.col("_l")))
    mark = F.when(F.startswith(F.col("_l"), F.lit("FILE:")), T.strip(F.replace(F.col("_l"), F.lit("FILE:"), F.lit(""))))
    w = Window.partitionBy(key).orderBy("line_no")
    lines = lines.withColumn("filename", F.last(mark, ignorenulls=True).over(w))
    return lines.where(F.startswith(F.col("_l"), F.lit("- ")) & (F.col("filename") != "")).select(key, "filename", "line_no", F.col("_l").alias("listing"))


def listings(df: DataFrame, key: str, response: str) -> DataFrame:
    """The JSON reading where a response parses, the line reading elsewhere; listings with exactly one leading "- "."""
    rows = df.select(key, response).repartition(key)  # parsing takes longer than the shuffle, and a small file is one task
    both = scratch.stored(parsed(rows, response), "responses")  # read twice, parsed once
    out = _entries(both.where("_files is not null"), key).unionByName(text_listings(both.where("_files is null"), key, response))
    return out.withColumn("listing", F.concat(F.lit("- "), F.regexp_replace("listing", "^(?:- )+", "")))


def dashed_lines(c: Column) -> Column:
    """The stripped lines of a text that start with "- "."""
    return F.filter(F.transform(F.split(c, "\n"), T.strip), lambda x: F.startswith(x, F.lit("- ")))


def anchors(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, href, anchor_text) of <a> elements with a quoted href, by pattern: JVM-side, for well-formed pages."""
    found = df.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*?href=\"[^\"]*\"[^>]*>.*?</a>)"), 1)).alias("pos", "_a"))
    return found.select(key, "pos", F.regexp_extract("_a", r"(?is)href=\"([^\"]*)\"", 1).alias("href"), F.trim(F.regexp_replace("_a", "(?s)<[^>]*>", "")).alias("anchor_text"))


class _Links(HTMLParser):
    """Links of a page with where they were found: anchors, frames and embeds, data attributes and scripts."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.open: list[list[str]] = []
        self.script = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {k: v for k, v in attrs if v}
        if tag == "a" and "href" in values:
            self.found.append(["anchor", values["href"], ""])
            self.open.append(self.found[-1])
        elif tag in ("iframe", "embed", "source") and "src" in values:
            self.found.append([tag, values["src"], ""])
        elif tag == "object" and "data" in values:
            self.found.append([tag, values["data"], ""])
        self.found += [["data", v, ""] for k, v in values.items() if k.startswith("data-") and ("://" in v or v.startswith("/"))]
        self.script = self.script or tag == "script"

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open:
            self.open.pop()
        elif tag == "script":
            self.script = False

    def handle_data(self, data: str) -> None:
        for link in self.open:
            link[2] += data
        if self.script:
            import re

            self.found += [["script", m, ""] for m in re.findall(r"https?://[^\s'\"<>\\]+", data)]


LINKS = S.StructType([S.StructField("pos", S.IntegerType()), S.StructField("place", S.StringType()), S.StructField("href", S.StringType()), S.StructField("url", S.StringType()), S.StructField("anchor_text", S.StringType())])


def links(df: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Every link of a page (key, pos, place, href, url made absolute, anchor_text), first of each url, by a real parser."""
    import pandas as pd

    schema = S.StructType([df.schema[key], *LINKS.fields])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for k, base, page in frame.itertuples(index=False, name=None):
                parser = _Links()
                parser.feed(page or "")
                seen: set[str] = set()
                for place, href, anchor in parser.found:
                    try:
                        full = urljoin(base or "", href)
                    except ValueError:
                        full = href
                    if full not in seen:
                        seen.add(full)
                        rows.append((k, len(seen) - 1, place, href, full, anchor.strip()))
            yield pd.DataFrame(rows, columns=schema.names)

    return df.select(key, url, html).mapInPandas(run, schema)
