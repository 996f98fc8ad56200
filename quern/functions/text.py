"""Text functions and predicates as Column expressions. None but path_digest leaves the JVM."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
#: White space as Python's str.split() and str.strip() see it.
SPACES = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
DEVANAGARI_DIGITS = "०१२३४५६७८९"
JOB_KEYWORDS = (
    "vacancy", "vacancies", "apply", "applications", "walk-in", "walk in", "interview", "recruitment", "job", "posts", "post", "salary", "walk-in-interview",
    "appointment", "employment", "hiring", "position", "opening", "opportunity", "requirement", "wanted", "needed", "candidate", "eligible", "qualification",
)
HINDI_TITLES = ("db", "dainik", "navbharat", "amar", "hindi", "amarujala", "bhaskar", "jantak")
ENGLISH_TITLES = ("the", "indianexpress", "express", "times", "hindu", "ie", "th", "english")
CODE_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("-", "&#45;"), (".", "&#46;"), ("(", "&#40;"), (")", "&#41;"), ("+", "&#43;"), ("=", "&#61;"), ("|", "&#124;"))
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))

# Named thresholds.
MIN_KEYWORDS = 2
SCRIPT_RATIO = 0.2
GIBBERISH_RATIO = 0.30
SHORT_WORDS, SHORT_CHARS, READABLE_CONFIDENCE = 12, 50, 40


def strip(c: Column) -> Column:
    """Removes white space, of any kind, at both ends."""
    return F.regexp_replace(c, f"^[{SPACES}]+|[{SPACES}]+$", "")


def non_empty(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def words(c: Column) -> Column:
    """The words between runs of white space; an empty array for blank or null text."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), f"[{SPACES}]+"), "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def keyword_score(c: Column, keywords: Sequence[str] = JOB_KEYWORDS) -> Column:
    """How many of the keywords the lower-cased text contains, as substrings: "posts" also counts for "post"."""
    low = F.lower(F.coalesce(c, F.lit("")))
    out = F.lit(0)
    for k in keywords:
        out = out + F.contains(low, F.lit(k)).cast("int")
    return out


def has_keywords(c: Column, keywords: Sequence[str] = JOB_KEYWORDS, least: int = MIN_KEYWORDS, force: bool = False) -> Column:
    return F.lit(True) if force else keyword_score(c, keywords) >= least


def share_of(c: Column, class_: str, of: str = "") -> Column:
    """The share of characters in the regex class among all characters, or among those in the class `of`; 0 of none."""
    text = F.coalesce(c, F.lit(""))
    part = F.length(F.regexp_replace(text, f"[^{class_}]", ""))
    whole = F.length(F.regexp_replace(text, f"[^{of}]", "") if of else text)
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def is_script(c: Column, class_: str = r"\u0900-\u097F", least: float = SCRIPT_RATIO) -> Column:
    """Whether at least a share of the characters is of a script (by default Devanagari); false for empty text."""
    return (share_of(c, class_) >= least) & (F.length(F.coalesce(c, F.lit(""))) > 0)


def is_gibberish(c: Column, least: float = GIBBERISH_RATIO) -> Column:
    """Whether too few of the visible characters are letters or digits; true for text without any."""
    text = F.coalesce(c, F.lit(""))
    good = F.length(F.regexp_replace(text, r"[^\u0900-\u097FA-Za-z0-9]", ""))
    visible = F.length(F.regexp_replace(text, f"[{SPACES}]", ""))
    return F.coalesce(F.try_divide(good, visible) < least, F.lit(True))


def is_short(c: Column) -> Column:
    return (word_count(c) <= SHORT_WORDS) | (F.length(F.coalesce(c, F.lit(""))) <= SHORT_CHARS)


def is_readable(confidences: Column) -> Column:
    return F.coalesce(F.exists(confidences, lambda x: x > READABLE_CONFIDENCE), F.lit(False))


def ascii_digits(c: Column) -> Column:
    return F.translate(c, DEVANAGARI_DIGITS, "0123456789")


def lstrip_set(c: Column, characters: str) -> Column:
    """Removes any of the characters, in any order, from the start."""
    return F.ltrim(c, F.lit(characters))


def one_line(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def without_nul(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\x00"), F.lit("")))


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n\s*\n", "\n\n")


def clean_ocr(c: Column) -> Column:
    out = F.regexp_replace(c, r"[\f\ufffd]", "")
    out = F.regexp_replace(out, "[ \t]+", " ")
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def clean_lines(c: Column) -> Column:
    """Every line stripped, blank lines dropped."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != ""), "\n")


def normalise_name(c: Column) -> Column:
    """Lower case; marks between words become spaces; d/m pairs and four-digit runs go; single spaces."""
    out = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[-_()\[\].]", " ")
    out = F.regexp_replace(out, r"\d{1,2}[-/]\d{1,2}|\d{4}", "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def clean_name(c: Column) -> Column:
    return F.replace(normalise_name(c), F.lit("express"), F.lit("ie"))


def name_contains(a: Column, b: Column) -> Column:
    """The containment half of the fuzzy name match, either way; an empty name matches everything."""
    x, y = normalise_name(a), normalise_name(b)
    return F.contains(x, y) | F.contains(y, x)


def safe_file_name(c: Column, longest: int = 200) -> Column:
    """Letters and digits of any script, _ - . and spaces as underscores; other characters, combining marks too, become _."""
    out = F.substring(F.regexp_replace(F.replace(strip(c), F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}_\-. ]", "_"), 1, longest)
    return F.when(F.length(F.coalesce(c, F.lit(""))) == 0, "file").otherwise(out)


def _escaped(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    out = F.coalesce(c, F.lit(""))
    for plain, code in pairs:
        out = F.replace(out, F.lit(plain), F.lit(code))
    return out


def escape_html(c: Column) -> Column:
    return _escaped(c, HTML_ESCAPES)


def escape_code(c: Column) -> Column:
    return _escaped(c, CODE_ESCAPES)


def preview(c: Column, longest: int) -> Column:
    return F.when(F.length(c) > longest, F.concat(F.substring(c, 1, longest), F.lit("..."))).otherwise(c)


def page_number(c: Column) -> Column:
    """The digits of the first `_p<digits>`, or "0"."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"_p(\d+)", 1), F.lit("")), F.lit("0"))


def anchored_page_number(c: Column) -> Column:
    """The number in a name that ends in `_p<digits>_text.txt`, or -1."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"_p(\d+)_text\.txt$", 1), F.lit("")).cast("int"), F.lit(-1))


def issue_prefix(c: Column, legacy: bool = False) -> Column:
    """What stands before the page mark, spaces as underscores. legacy cuts at the first `_p` of any kind."""
    cut = F.substring_index(c, "_p", 1) if legacy else F.regexp_replace(c, r"_p\d+.*$", "")
    return F.replace(cut, F.lit(" "), F.lit("_"))


def after_last_page_mark(c: Column) -> Column:
    return F.element_at(F.split(c, "_p"), -1)


def stable_id(parts: Sequence[Column], text: Column, digits: int = 12) -> Column:
    """parts joined by "/", ":" and the first hexadecimal digits of the text's SHA-256."""
    return F.concat(F.concat_ws("/", *parts), F.lit(":"), F.substring(F.sha2(text, 256), 1, digits))


def contains_any(c: Column, keys: Sequence[str], whole_words: bool = False) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    if whole_words:
        return low.rlike(r"\b(?:" + "|".join(keys) + r")\b")
    out = F.lit(False)
    for k in keys:
        out = out | F.contains(low, F.lit(k))
    return out


def title_languages(c: Column) -> Column:
    """Reader languages for a publication's title: Hindi keys are tested first, and both languages are the default."""
    both, english = F.array(F.lit("hi"), F.lit("en")), F.array(F.lit("en"))
    return F.when(contains_any(c, HINDI_TITLES), both).when(contains_any(c, ENGLISH_TITLES), english).otherwise(both)


def fill_template(template: str, mark: str, c: Column) -> Column:
    """The template with only `mark` replaced; other braces stay."""
    return F.replace(F.lit(template), F.lit(mark), c)


def title_case(c: Column) -> Column:
    """Every run of letters with its first one in upper case and the rest in lower case."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def path_digest(c: Column) -> Column:
    """The BLAKE2b digest of 8 bytes, in hexadecimal, by which a file's cache entry is named."""
    @F.pandas_udf("string")
    def digest(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: None if p is None else hashlib.blake2b(p.encode(), digest_size=8).hexdigest())

    return digest(c)


def first_field(c: Column) -> Column:
    """The first |-separated field of the first line without its numbering; null if there is none or it is too short."""
    line = F.substring_index(c, "\n", 1)
    field = F.regexp_replace(strip(F.substring_index(line, "|", 1)), r"^\d+\.\s*-\s*", "")
    return F.when(F.contains(line, F.lit("|")) & (F.length(field) > 3), field)


def without_fence(c: Column) -> Column:
    """The inside of a text that starts with a Markdown fence; the text itself otherwise."""
    fenced = F.startswith(c, F.lit("```")) & (F.locate("```", c, 4) > 0)
    return F.when(fenced, strip(F.get(F.split(c, "```"), F.lit(1)))).otherwise(c)


def outer_braces(c: Column) -> Column:
    """From the first { to the last }; null where there is no such pair."""
    first, last = F.locate("{", c), F.length(c) - F.locate("}", F.reverse(c)) + 1
    return F.when((first > 0) & F.contains(c, F.lit("}")) & (last > first), F.substr(c, first, last - first + 1))
