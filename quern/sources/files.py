"""Sources: text, binary and table scans, and the sinks and state they pair with. Paths may be of any store Spark reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quern.functions import text as T

# Fixed values.
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp")
FAILED_IMAGE_PATTERNS = (r"\[⚠ missing\]\s+(.+?\.png)", r"\[🚫\]\s+(.+?\.png)", r"OCR failed on\s+(.+?\.png)", r"\[✖\].*?\s+(.+?\.png)", r"\[❌\]\s+No text from:\s+(.+?\.png)")
INTERACTION_CHARS = 4000
#: Partitions of a file scan that one task takes: Spark deals some thirty small files to each, however many there are.
SCANS_PER_TASK = 32
ANALYSIS = "job_id string, job_text string, similarity double, best_resume string, gemini_response string, application_status string, processed_at string"


def file_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def folder_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -2)


def in_fewer_tasks(scan: DataFrame) -> DataFrame:
    """A scan of many small files in tasks of SCANS_PER_TASK partitions, but two for each core at least. Nothing is shuffled."""
    return scan.coalesce(max(2 * scan.sparkSession.sparkContext.defaultParallelism, -(-scan.rdd.getNumPartitions() // SCANS_PER_TASK)))


def binary_files(spark: SparkSession, path: str, suffixes: Sequence[str], recursive: bool = True, without_prefix: str = "") -> DataFrame:
    """path, name, folder, modificationTime, length and content of files whose lower-cased name ends in a suffix."""
    df = in_fewer_tasks(spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path))
    df = df.withColumns({"name": file_name(F.col("path")), "folder": folder_name(F.col("path"))})
    keep = F.lit(False)
    for s in suffixes:
        keep = keep | F.lower("name").endswith(s)
    return df.where(keep & ~F.startswith("name", F.lit(without_prefix)) if without_prefix else keep)


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    return binary_files(spark, path, (".pdf",))


def image_files(spark: SparkSession, path: str, recursive: bool = True, without_debug: bool = True) -> DataFrame:
    return binary_files(spark, path, IMAGE_SUFFIXES, recursive, "debug_" if without_debug else "")


def empty_files(path: str, manifest: DataFrame) -> DataFrame:
    """(path) of the files of a writer's manifest (name, bytes) that hold nothing: Spark's scans give files with bytes only."""
    return manifest.where("bytes = 0").select(F.concat(F.lit(f"{path}/"), "name").alias("path"))


def text_lines(spark: SparkSession, path: str, manifest: DataFrame | None = None) -> DataFrame:
    """(path, line_no, line): lines numbered from 0 within each file, whatever the size of the file's splits. One newline at the
    very end of a file begins no line. An empty file has an empty line, if the manifest of the files' writer names it.

    Files are read whole, one task each, since numbering needs a file's lines together; a page is small by its meaning."""
    whole = whole_texts(spark, path)
    if manifest is not None:
        whole = whole.unionByName(empty_files(path, manifest.where(F.endswith("name", F.lit(".txt")))).withColumn("text", F.lit("")))
    # \z, as $ also stands before a line end at the end
    return whole.select("path", F.posexplode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n")).alias("line_no", "line"))


def whole_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(path, text) of each text file. They are read as bytes, since the text source sets up a Hadoop reader for each file."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return in_fewer_tasks(df).select("path", F.col("content").cast("string").alias("text"))


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(issue, page, text) of `<issue>_p<n>_text.txt` files, stripped, without blank pages; order by issue and page."""
    df = whole_texts(spark, path, "*_p*_text.txt").withColumn("name", file_name(F.col("path")))
    out = df.select(T.issue_prefix(F.col("name")).alias("issue"), T.anchored_page_number(F.col("name")).alias("page"), T.strip(F.col("text")).alias("text"))
    return out.where(F.length("text") > 0)


def prefiltered(df: DataFrame, text: str, keep: Column) -> DataFrame:
    """Adds status: "candidate" for clean texts that pass, "skipped" for blank ones and the rest; none is lost."""
    clean = T.without_nul(F.col(text))
    return df.withColumn(text, clean).withColumn("status", F.when(T.non_empty(clean) & keep, "candidate").otherwise("skipped"))


def listing_lines(spark: SparkSession, path: str, glob: str = "*_jobs.txt") -> DataFrame:
    """(issue, file, line_no, raw) of non-blank listing lines; issue is what precedes the page mark of the name."""
    df = whole_texts(spark, path, glob).withColumn("file", file_name(F.col("path")))
    lines = df.select(T.issue_prefix(F.col("file")).alias("issue"), "file", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    return lines.withColumn("raw", T.strip(F.col("raw"))).where(F.length("raw") > 0)


def jobs(spark: SparkSession, path: str) -> DataFrame:
    """(job_id, job_text): listing lines without bullets and pins; the last of equal ids stays."""
    from quern.operators.dedup import first_of

    df = whole_texts(spark, path, "*_jobs_all.txt")
    lines = df.select(folder_name(F.col("path")).alias("folder"), file_name(F.col("path")).alias("file"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    clean = T.strip(T.lstrip_set(F.col("raw"), "📌 "))
    out = lines.withColumn("job_text", clean).where(T.non_empty(clean))
    out = out.withColumn("job_id", T.stable_id([F.col("folder"), F.col("file")], F.col("job_text")))
    return first_of(out, ["job_id"], [F.desc("pos")]).select("job_id", "job_text")


def profiles(spark: SparkSession, path: str) -> DataFrame:
    return whole_texts(spark, path).select(file_name(F.col("path")).alias("profile_id"), T.one_line(F.col("text")).alias("text"))


def json_rows(spark: SparkSession, path: str, schema: str = ANALYSIS) -> DataFrame:
    """Rows of a JSON array file; anything that does not fit fails the read."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def latest(spark: SparkSession, path: str, glob: str = "*.json") -> str | None:
    """The file that was modified last, the last by name on ties."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "modificationTime")
    row = files.agg(F.max(F.struct("modificationTime", "path")).alias("m")).first()
    return row.m.path if row.m else None


def failed_images(spark: SparkSession, path: str, patterns: Sequence[str] = FAILED_IMAGE_PATTERNS) -> DataFrame:
    """(image) named by the lines of a log that report a failure."""
    found = F.coalesce(*[F.nullif(F.regexp_extract("value", p, 1), F.lit("")) for p in patterns])
    return spark.read.text(path).select(found.alias("image")).where("image is not null").distinct()


def schedule(spark: SparkSession, path: str) -> DataFrame:
    """(name, time, enabled, command) of a |-separated table; blank lines and those that start with # are left out."""
    lines = spark.read.text(path).select(T.strip(F.col("value")).alias("v")).where("v != '' and not startswith(v, '#')")
    field = lambda k: T.strip(F.get(F.split("v", r"\|"), F.lit(k)))
    return lines.select(field(0).alias("name"), field(1).alias("time"), field(2).alias("enabled"), field(3).alias("command"))


def templated_urls(df: DataFrame, pattern: str, day: Column, spelling: Column) -> DataFrame:
    """Adds url: the pattern with {date} replaced by the day's spelling."""
    return df.withColumn("url", F.replace(F.col(pattern), F.lit("{date}"), F.call_function("date_format", day, spelling)))


def attachment_text(name: Column, content: Column) -> Column:
    """The text of a text-like attachment; a placeholder for others."""
    texty = F.lower(name).rlike(r"\.(txt|md|csv|log)$")
    return F.when(texty, F.decode(content, "UTF-8")).when(content.isNull(), "").otherwise(F.concat(F.lit("[unsupported file: "), name, F.lit("]")))


def write_text(df: DataFrame, path: str, text: str, by: Sequence[str] = ()) -> None:
    """One text file tree; Spark's commit makes it appear whole or not at all."""
    df.select(*by, text).write.partitionBy(*by).text(path) if by else df.select(text).write.text(path)


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "errorifexists").json(path)


def request_log(df: DataFrame, path: str, prompt_chars: int = 1000, response_chars: int = 2000) -> None:
    """Appends requests with prompts and responses cut; interactions are logged with both cut at INTERACTION_CHARS."""
    df.withColumns({"prompt": F.substring("prompt", 1, prompt_chars), "response": F.substring("response", 1, response_chars)}).write.mode("append").parquet(path)


STATE = S.StructType([S.StructField("file_path", S.StringType()), S.StructField("processed_at", S.TimestampType()), S.StructField("has_jobs", S.BooleanType()), S.StructField("job_count", S.LongType()), S.StructField("skipped_fast", S.BooleanType())])


def report(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A Markdown report of a ranked shortlist: counts, a section for each row, its tier. More than `most` rows are an error,
    as a report is read by a person and made on the driver."""
    from quern.functions.records import tier

    listed = rows.withColumn("tier", tier(F.col("similarity"))).orderBy(F.desc("similarity"), "job_id").limit(most + 1).collect()
    if len(listed) > most:
        raise ValueError(f"more than {most} rows for one report")
    parts = [f"# {title}", "", f"{len(listed)} entries", ""]
    for k, r in enumerate(listed, 1):
        parts += [f"## {k}. {r.job_id}", "", r.job_text, "", f"- similarity: {r.similarity:.3f}", f"- tier: {r.tier}", ""]
    return "\n".join(parts)
