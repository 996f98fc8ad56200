"""Extractors and classifiers for listings, links and sizes, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import text as T

# Fixed values.
EMPLOYER = r"([A-Z][A-Za-z\s&]+(?:Limited|Corporation|Institute|University|Commission|Company|Services|Solutions|Power|Authority|Board|Department))"
DEADLINE = r"(?:apply|last\s*date|by)\s*(\d{1,2}\s*\w+\s*\d{4})"
DEADLINE_MONTH_FIRST = r"(?:apply|last\s*date|by)\s*(\w+\s*\d{1,2},?\s*\d{4})"
URL = r"(https?://[^\s]+)"
DRIVE_HOSTS = ("drive.google.com", "drive.googleusercontent.com", "drive.usercontent.google.com", "/uc?id=")
DRIVE_IDS = (r"/file/d/([a-zA-Z0-9_-]{10,})", r"[?&]id=([a-zA-Z0-9_-]{10,})", r"/d/([a-zA-Z0-9_-]{10,})", r"/uc\?id=([a-zA-Z0-9_-]{10,})", r"[?&]id=([^&#]+)")
PROFILES = (
    ("ee", ("engineer", "electrical", "transformer", "bms", "plc", "scada")),
    ("aiml", ("data", "ai", "ml", "python", "vision", "deep", "model")),
)
TIPS = (
    (("experience",), "Add recent project experience section to resume."),
    (("communication", "team"), "Highlight teamwork and presentation achievements."),
    (("portfolio", "github"), "Ensure portfolio and GitHub are updated with relevant projects."),
    (("scada", "transformer", "plc"), "Add relevant SCADA or Transformer project experience."),
    (("python", "machine learning", "ai"), "Highlight Python and ML projects in your portfolio."),
)
NO_TIP = "Tailor resume to match specific keywords from job description."
NO_EMPLOYER, NO_DEADLINE, NO_URL = "Unknown Organization", "Not specified", "No URL provided"
CHALLENGES = ("checking your browser", "please wait", "var _cf_chl_ctx", "ddos", "just a moment")
UNITS = ("B", "KB", "MB", "GB", "TB")

# Named thresholds.
HIGH, GOOD = 0.37, 0.34
MIN_PDF_BYTES = 100_000
MIN_DPI, MAX_DPI, TALL_DPI = 150, 300, 200


def extracted(c: Column, pattern: str, flags: str = "(?i)") -> Column:
    """The first group of the first match, or null."""
    return F.nullif(F.regexp_extract(c, flags + pattern, 1), F.lit(""))


def employer(c: Column) -> Column:
    return F.coalesce(T.strip(extracted(c, EMPLOYER)), T.first_field(c), F.lit(NO_EMPLOYER))


def deadline(c: Column, extended: bool = False) -> Column:
    """The date after "apply", "last date" or "by". extended also reads dates whose month comes first."""
    found = extracted(c, DEADLINE)
    return F.coalesce(found, extracted(c, DEADLINE_MONTH_FIRST), F.lit(NO_DEADLINE)) if extended else F.coalesce(found, F.lit(NO_DEADLINE))


def website(c: Column) -> Column:
    return F.coalesce(extracted(c, URL, ""), F.lit(NO_URL))


def job_facts(c: Column) -> Column:
    return F.struct(employer(c).alias("employer"), deadline(c).alias("apply_by"), website(c).alias("website"))


def choose_profile(c: Column, whole_words: bool = False) -> Column:
    out = F.lit("hybrid")
    for name, keys in reversed(PROFILES):
        out = F.when(T.contains_any(c, keys, whole_words), name).otherwise(out)
    return out


def tip(c: Column) -> Column:
    out = F.lit(NO_TIP)
    for keys, text in reversed(TIPS):
        out = F.when(T.contains_any(c, keys), text).otherwise(out)
    return out


def is_recommended(response: Column, strict: bool = False) -> Column:
    """The four shortlist rules on a response. strict refuses a score of 3 that comes with "not recommended"."""
    low = F.lower(F.coalesce(response, F.lit("")))
    has = lambda s: F.contains(low, F.lit(s))
    good = has("recommended") & ~has("not recommended")
    three = has("match score: 3") & (good if strict else has("recommended"))
    return good | has("match score: 4") | has("match score: 5") | three | has("verdict: recommended")


def score_text(response: Column) -> Column:
    """What stands between the first "match score:" and the next "/5"; "N/A" without both."""
    low = F.lower(F.coalesce(response, F.lit("")))
    start = F.locate("match score:", low)
    rest = F.substr(low, start + len("match score:"))
    end = F.locate("/5", rest)
    return F.when((start > 0) & (end > 0), T.strip(F.substr(rest, F.lit(1), end - 1))).otherwise("N/A")


def score_value(response: Column) -> Column:
    """The score as a number; null for anything that is not a plain decimal number."""
    found = score_text(response)
    return F.when(found.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"), found.try_cast("double"))


def tier(similarity: Column) -> Column:
    return F.when(similarity > HIGH, "high").when(similarity > GOOD, "good").otherwise("moderate")


def token_budget(chars: Column, batch: bool = False) -> Column:
    if batch:
        return F.when(chars < 8000, 3000).when(chars < 20000, 6000).otherwise(8000)
    return F.when(chars < 2000, 1200).when(chars < 6000, 2500).otherwise(4000)


def link_type(url: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.when(T.contains_any(url, DRIVE_HOSTS), "gdrive").when(low.endswith(".pdf"), "direct_pdf").when(F.contains(low, F.lit("pdf")), "likely_pdf").otherwise("unknown")


def drive_id(url: Column) -> Column:
    return F.coalesce(*[extracted(url, p, "") for p in DRIVE_IDS])


def resource_key(url: Column) -> Column:
    return F.try_url_decode(extracted(url, r"[?&]resourcekey=([^&#]+)"))


def direct_pdf(c: Column) -> Column:
    """A direct address for a text or url that points at a PDF: itself, a drive file, or the url inside a viewer's."""
    drive = F.coalesce(extracted(c, DRIVE_IDS[0], ""), extracted(c, DRIVE_IDS[1], ""))
    inner = F.try_url_decode(extracted(c, r"""(?:viewer|gview)[^\s'"<>]*\?url=(https?%3A%2F%2F[^\s'"<>]+)""", ""))
    return F.coalesce(
        extracted(c, r"""(https?://[^\s'"<>]+\.pdf)"""),
        F.when(drive.isNotNull(), F.concat(F.lit("https://drive.google.com/uc?id="), drive, F.lit("&export=download"))),
        F.when(F.lower(inner).endswith(".pdf"), inner),
    )


def is_challenge(html: Column) -> Column:
    """Whether a page only asks the browser to wait."""
    return T.contains_any(html, CHALLENGES)


def is_pdf(content: Column, least: int = MIN_PDF_BYTES) -> Column:
    """Large enough, the right header, and an end mark in the last kilobyte."""
    tail = F.substr(content, F.greatest(F.lit(1), F.length(content) - 1023))
    return F.coalesce((F.length(content) >= least) & F.startswith(content, F.lit(b"%PDF")) & F.contains(tail, F.lit(b"%%EOF")), F.lit(False))


def readable_size(size: Column) -> Column:
    """A size in the largest unit that leaves no more than 1024 of it (terabytes at most), two decimals."""
    out = F.format_string("%.2f TB", size / 1024**4)
    for k in range(3, -1, -1):
        out = F.when(size <= 1024 ** (k + 1), F.format_string(f"%.2f {UNITS[k]}", size / 1024**k)).otherwise(out)
    return out


def dpi(width: Column, height: Column, ratio: Column) -> Column:
    """A page's resolution from an estimate, capped for very large pages and clamped."""
    capped = F.when((width > 2000) | (height > 3000), F.least(ratio, F.lit(TALL_DPI))).otherwise(ratio)
    return F.least(F.greatest(capped, F.lit(MIN_DPI)), F.lit(MAX_DPI))


def backoff(base: float, attempt: Column, cap: float) -> Column:
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(cap)))


def token_metrics(prompt_chars: Column, response_chars: Column, seconds: Column) -> list[Column]:
    """Estimated tokens (a quarter of the characters) and their rate; 0 where no time passed."""
    prompt, response = F.floor(prompt_chars / 4).cast("long"), F.floor(response_chars / 4).cast("long")
    rate = F.when(seconds > 0, (prompt + response) / seconds).otherwise(0.0)
    return [prompt.alias("prompt_tokens"), response.alias("response_tokens"), (prompt + response).alias("total_tokens"), rate.alias("tokens_per_second")]
