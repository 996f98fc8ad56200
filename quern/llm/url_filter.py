"""URL filters: rules for hosts and paths, and a logistic regression on hashed character n-grams for the rest.

The regression is trained on a small labelled URL table on the driver and is a vector of DIMENSIONS weights. Its features are
the distinct n-grams of `host` and `path`, each with its own start and end marks, so "spam" in a host and in a path are
different evidence. Rules are expressions; scoring is one vectorised function. Nothing is shuffled.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import common

#: (host, path prefix, verdict). A rule fits its host and all subdomains if the path starts with its path.
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
DIMENSIONS = 1 << 15
SHORTEST, LONGEST = 3, 5
EPOCHS, RATE, DECAY = 300, 0.5, 1e-4
THRESHOLD = 0.5
#: Rows of the labelled table that the driver will fetch and train on.
MOST_LABELLED = 100_000
#: What host names of the labelled table are about, blocked and allowed, and words that stand beside both.
BLOCKED_TERMS = "casino jackpot poker slots lotto bets pills pharma viagra replica cheap adult xxx escort spam clickbait ads popup tracker free".split()
ALLOWED_TERMS = "news library science weather museum school travel cooking university garden history sports music health council trade theatre nature village train".split()
BESIDE = "online shop club today net city best my live daily world home big new center".split()
#: Allowed hosts of no meaning, spelt by a rule, so that letters that say nothing speak for neither side.
MADE_UP = 60
HELD_OUT_ONE_IN = 4
PREFIXES, ZONES, PAGES = ("", "www.", "m.", "blog."), ("example.com", "example.net", "example.org"), ("/en/12", "/de/345/", "/fr/67.html", "/es/890", "/about", "/")


def made_up(k: int) -> str:
    """A host word of two to four syllables."""
    return "".join("bcdfghjklmnprstvwz"[(k * 7 + i * 5 + k // 3) % 18] + "aeiou"[(k + i * i + k // 5) % 5] + "nrslt "[(k * 3 + i) % 6].strip() for i in range(2 + k % 3))


def words() -> list[tuple[str, int]]:
    """(host word, blocked) of the labelled table: each term with four words beside it, before or behind, hyphened or not."""
    out = []
    for terms, blocked in ((BLOCKED_TERMS, 1), (ALLOWED_TERMS, 0)):
        for i, term in enumerate(terms):
            for j in range(4):
                pair = (term, BESIDE[(3 * i + 4 * j) % len(BESIDE)])
                out.append((("-" if (i + j) % 3 else "").join(pair if j % 2 else pair[::-1]), blocked))
    return out + [(made_up(k), 0) for k in range(MADE_UP)]


def held_out(word: str) -> bool:
    return zlib.crc32(word.encode()) % HELD_OUT_ONE_IN == 0


def labelled_rows(chosen: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """(url, blocked): every word with a few prefixes, zones and pages, the same for both labels."""
    return [(f"http://{PREFIXES[(i + j) % 4]}{word}.{ZONES[(i + 2 * j) % 3]}{PAGES[(i * 2 + j) % 6]}", blocked) for i, (word, blocked) in enumerate(chosen) for j in range(4)]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, blocked)."""
    return spark.createDataFrame(labelled_rows(words()), "url string, blocked int")


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; null where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(common.ascii_lower(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def ngram_slots(host: str, path: str) -> np.ndarray:
    """Ascending distinct slots of the n-grams of a url."""
    out = set()
    for mark, part in ((b"h", host), (b"p", path)):
        raw = b"^" + part.encode("utf-8", "surrogatepass") + b"$"
        for n in range(SHORTEST, LONGEST + 1):
            for i in range(len(raw) - n + 1):
                out.add(zlib.crc32(mark + raw[i : i + n]) % DIMENSIONS)
    return np.array(sorted(out), dtype=np.int64)


def train(examples: list[tuple[str, str, int]]) -> tuple[np.ndarray, float]:
    """(weights, bias) from (host, path, blocked) rows, by full-batch gradient descent with decay; both labels
    weigh the same in all; deterministic."""
    slots = [ngram_slots(h, p) for h, p, _ in examples]
    label = np.array([y for _, _, y in examples], dtype=float)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not len(label):
        return weights, bias
    row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    flat = np.concatenate(slots)
    scale = 1 / np.sqrt([max(1, len(s)) for s in slots])
    share = np.clip(label.mean(), 1e-6, 1 - 1e-6)
    weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share))  # both labels weigh the same in all
    for _ in range(EPOCHS):
        z = bias + np.bincount(row, weights[flat], len(slots)) * scale
        error = (1 / (1 + np.exp(-z)) - label) * weight
        weights -= RATE * (np.bincount(flat, (error * scale)[row], DIMENSIONS) + DECAY * weights)
        bias -= RATE * error.mean()
    return weights, bias


def probability(host: str, path: str, weights: np.ndarray, bias: float) -> float:
    slots = ngram_slots(host, path)
    return float(1 / (1 + np.exp(-(bias + weights[slots].sum() / np.sqrt(max(1, len(slots)))))))


def rule_columns(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, as expressions; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # later ones are tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labelled: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """One row per row of pages (page_id, url): page_id, host, path, rule, verdict and the model's probability of a block.

    A null url or one without `://` has an empty host and path, fits no rule and is judged by the model like any other.
    labelled (url, blocked) must be small: it is fetched, and more than MOST_LABELLED rows are an error. Repeated rows repeat, extra columns are ignored, an empty
    table gives an empty result, and with an empty labelled table the model is indifferent and allows."""
    split = labelled.select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"), "blocked")
    if labelled.limit(MOST_LABELLED + 1).count() > MOST_LABELLED:
        raise ValueError(f"more than {MOST_LABELLED} labelled urls")
    weights, bias = train([(r.h, r.p, r.blocked) for r in split.orderBy("h", "p", "blocked").collect()])
    sent = pages.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    @F.pandas_udf("double")
    def blocked(host: pd.Series, path: pd.Series) -> pd.Series:
        w, b = sent.value
        return pd.Series([probability(h, p, w, b) for h, p in zip(host, path, strict=True)], dtype="float64")

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": rule, "_rule_verdict": verdict, "p_block": blocked("host", "path")})
    learned = F.when(F.col("p_block") > THRESHOLD, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_rule_verdict", learned).alias("verdict"), "p_block")
