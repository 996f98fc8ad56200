"""Personal data: fixed base patterns, and boosted trees over further candidates.

Base spans (email, ip, card, phone) are found by fixed patterns and always stay. High-recall generators then propose
overlapping spans that the patterns miss: spelt-out addresses, national phone numbers, account and identity numbers,
hardware and IPv6 addresses, access tokens. Gradient-boosted trees score a candidate by its format and its context, and a
threshold for each kind, calibrated to PRECISION on examples of other formats and contexts, selects what is added.
Candidates that overlap a base span or a better candidate are not added.

The trees are grown on the driver from examples that a seeded rule writes (formats in telling and in misleading
contexts); no document is learned from.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

# Fixed patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the method adds; they follow the base kinds in the order of spans.
MORE_KINDS = ("account", "device", "identity", "secret")
ORDER = {k: i for i, k in enumerate(KINDS + MORE_KINDS)}
GENERATORS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\}|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\(dot\)|\[dot\]|\sdot\s|\.)\s?[A-Za-z0-9-]{2,24}){1,4}")),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+])\(?0?[0-9]{2,5}\)?(?:[ ./-]?[0-9]{2,6}){1,5}(?![0-9A-Za-z])")),
    ("account", re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")),
    ("device", re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?:[:-][0-9A-Fa-f]{1,4}){5,7}(?![0-9A-Fa-f:])")),
    ("identity", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z_-]{24,}(?![0-9A-Za-z])")),
)
CONTEXT = 32
#: Words before a span that speak for a kind of personal data, by feature.
HINTS = (
    re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|téléphone|teléfono)\b"),
    re.compile(r"(?i)\b(?:mail|email|e-mail|contact|write|reach)\b"),
    re.compile(r"(?i)\b(?:iban|account|konto|compte|cuenta|bank)\b"),
    re.compile(r"(?i)\b(?:ssn|social security|passport|identity|id card|national id)\b"),
    re.compile(r"(?i)\b(?:token|secret|password|api[_ -]?key|key|bearer)\b"),
    re.compile(r"(?i)\b(?:mac|device|ipv6|host|address)\b"),
    re.compile(r"(?i)\b(?:order|isbn|issn|page|pages|version|no|nr|item|invoice|since|year|chapter|build|total|price|eur|usd)\b"),
)
#: Common last labels of domain names.
TOP_LEVEL = frozenset("com org net edu gov io info biz de fr es uk it nl eu ch at us co".split())
TREES, DEPTH, RATE, CUTS = 60, 3, 0.3, 12
PRECISION = 0.97
#: Candidates of a text that are scored together.
SCORED_AT_ONCE = 4096
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Leftmost matches of local part and domain, by walking back from each @: linear however long a run is."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind that pass its test; a failing match is dropped for good."""
    out = emails(text) if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of all generators."""
    out = []
    digits = DIGIT.search(text) is not None
    spelt = "at)" in text or "at]" in text or "at}" in text or (" at " in text and (" dot " in text or "." in text))
    for kind, pattern in GENERATORS:
        # a generator is skipped only where the text lacks what every match of it holds
        if spelt if kind == "email" else (kind == "secret" or digits or (kind == "device" and (":" in text or "-" in text))):
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    body, before, after = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + 2]
    digits = digits_of(body)
    letters = sum(c.isalpha() for c in body)
    groups = re.findall("[0-9]+", body)
    return [
        float(ORDER[kind]),
        len(body),
        len(digits),
        letters,
        sum(c.isupper() for c in body),
        len(groups),
        max((len(g) for g in groups), default=0),
        min((len(g) for g in groups), default=0),
        sum(c in " ./-" for c in body),
        len({c for c in body if not c.isalnum()}),
        float(body.startswith(("0", "(0", "("))),
        float(" dot " in body or "(dot)" in body or "[dot]" in body),
        float(re.search(r"[.\s]\s", body) is not None and "dot" not in body),
        float(body.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].lower() in TOP_LEVEL),
        float(any(m in body for m in ("(at)", "[at]", "{at}"))),
        len(set(body.lower())) / max(1, len(body)),
        float(digits != "" and luhn(digits)),
        float(all(c in "0123456789abcdefABCDEF" for c in body)),
        float(before[-1:] in ('"', "'", "=", ":")),
        float(after[:1] in ('"', "'", "%", "€", "$")),
        *[float(h.search(before) is not None) for h in HINTS],
    ]


class Trees:
    """Gradient-boosted regression trees for the logistic loss, on binned features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        self.trees: list[list[tuple[int, int, float]]] = []
        z = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            tree: list[tuple[int, int, float]] = [(-1, 0, 0.0)] * (2 ** (DEPTH + 1) - 1)
            self.grow(tree, 0, np.arange(len(y)), binned, y - p, p * (1 - p))
            self.trees.append(tree)
            z = z + RATE * self.walk(tree, binned)

    def grow(self, tree: list, node: int, rows: np.ndarray, binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray) -> None:
        g, w = gradient[rows].sum(), weight[rows].sum()
        best = (1e-6, -1, 0)
        if node < 2**DEPTH - 1 and len(rows) >= 10:
            for f in range(binned.shape[1]):
                n = len(self.cuts[f]) + 1
                gs, ws = (np.bincount(binned[rows, f], v[rows], n).cumsum()[:-1] for v in (gradient, weight))
                if len(gs):
                    gain = gs**2 / (ws + 1) + (g - gs) ** 2 / (w - ws + 1) - g**2 / (w + 1)
                    k = int(gain.argmax())
                    best = max(best, (float(gain[k]), f, k))
        if best[1] < 0:
            tree[node] = (-1, 0, float(g / (w + 1)))
            return
        _, f, k = best
        tree[node] = (f, k, 0.0)
        low = binned[rows, f] <= k
        self.grow(tree, 2 * node + 1, rows[low], binned, gradient, weight)
        self.grow(tree, 2 * node + 2, rows[~low], binned, gradient, weight)

    @staticmethod
    def walk(tree: list, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = (np.array(v) for v in zip(*tree, strict=True))
        at = np.zeros(len(binned), dtype=np.int64)
        for _ in range(DEPTH):
            f = feature[at]
            down = 2 * at + 1 + (binned[np.arange(len(binned)), np.maximum(f, 0)] > cut[at])
            at = np.where(f < 0, at, down)
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)], axis=1)
        return 1 / (1 + np.exp(-(self.base + RATE * sum(self.walk(t, binned) for t in self.trees))))


def examples(seed: int, n: int) -> list[tuple[str, Span, int]]:
    """n labelled candidates (text, span, personal), written by a seeded rule."""
    rng = random.Random(seed)
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    out: list[tuple[str, Span, int]] = []
    while len(out) < n:
        kind = rng.choice(("email", "phone", "phone", "account", "device", "identity", "secret"))
        good = rng.random() < 0.5
        neutral = " ".join(word() for _ in range(rng.randint(2, 5)))
        if kind == "email":
            at, dot = rng.choice(((" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "[dot]"), (" [at] ", ".")))
            body = f"{word()}{rng.choice(('', '.' + word(), number(2)))}{at}{word()}{dot}{rng.choice(('com', 'org', 'net', 'de'))}" if good else rng.choice((f"{word()} at {word()}.{word()}", f"{word()} at {word()}. {word().title()}", f"{word()} at {word()}.\n{word().title()}", f"{word()} at the.\n{word().title()}", f"{word()} at {word()}. {word().title()}.\n{word().title()}", f"{word()} at {word()}. {word().title()}. {word().title()}"))
            lead = rng.choice((neutral, "mail", "contact me:", "write to")) if good else neutral
        elif kind == "phone":
            body = rng.choice((f"({number(3)}) {number(3)}-{number(4)}", f"0{number(3)} {number(7)}", f"0{number(2)}-{number(4)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}")) if good else rng.choice((number(rng.randint(4, 7)), f"{number(4)}-{number(4)}", f"{number(2)}.{number(2)}.{number(4)}", f"{number(4)} {number(4)}", number(16), f"{number(16)} {number(16)}"))
            lead = rng.choice(("phone", "call", "Tel:", "mobile", neutral)) if good else rng.choice(("order", "isbn", "since", "page", "version", neutral))
        elif kind == "account":
            body = rng.choice(("DE", "FR", "ES", "GB")) + number(2) + " " + " ".join(number(4) for _ in range(rng.randint(3, 5))) if good else rng.choice(("AB", "XY", "NO")) + number(2) + "".join(rng.choice("ABCDEFGH") for _ in range(8))
            lead = rng.choice(("IBAN", "account", "konto", neutral)) if good else rng.choice(("item", "build", neutral))
        elif kind == "device":
            body = ":".join(hexes(2) for _ in range(6)) if good else "-".join(number(rng.randint(1, 2)) for _ in range(6))
            lead = rng.choice(("mac", "device", "address", neutral)) if good else neutral
        elif kind == "identity":
            body = f"{number(3)}-{number(2)}-{number(4)}"
            lead = rng.choice(("SSN", "social security", "identity", neutral)) if good else rng.choice(("item", "order", "invoice"))
        else:
            body = rng.choice((hexes(40), hexes(32), hexes(64), "".join(rng.choice("ABCDEFGHabcdefgh0123456789") for _ in range(36)))) if good else rng.choice(("-".join(word() for _ in range(6)), "_".join(word() for _ in range(5)), word() * 6, number(26)))
            lead = rng.choice(('token = "', "password:", "api_key=", "secret ")) if good else neutral
        text = f"{neutral} {lead}{'' if lead[-1] in '=\"' else ' '}"
        a = len(text)
        text += body + rng.choice((" ", ".", ",", '"' if lead.endswith('"') else " ")) + neutral
        out.append((text, (kind, a, a + len(body)), int(good)))
    return out


def other_examples(seed: int, n: int) -> list[tuple[str, Span, int]]:
    """n labelled candidates in lines of another kind (forms, configuration, logs, prose, signatures), by which thresholds are
    calibrated: their formats and contexts are not those that the trees are grown on."""
    rng = random.Random(seed)
    vowels, rest = "aeiouy", "bcdfghklmnprstvz"
    name = lambda: "".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
    n_digits = lambda k: str(rng.randrange(10 ** (k - 1), 10**k))
    mixed = lambda k: "".join(rng.choice("0123456789abcdefABCDEFGHKLMNPQRSTUVWXYZ") for _ in range(k))
    hexes = lambda k: f"{rng.getrandbits(4 * k):0{k}x}"
    good = (
        ("email", lambda: f"{name()}.{name()} (at) {name()} (dot) com", ("Reply: ", "E-Mail: ", "Signed, ")),
        ("email", lambda: f"{name()}[at]{name()}.org", ("Author ", "<", "by ")),
        ("email", lambda: f"{name()} at {name()} dot net", ("mail me, ", "reach ")),
        ("phone", lambda: f"({n_digits(3)}) {n_digits(3)}-{n_digits(4)}", ("Office ", "Mobile: ", "call ")),
        ("phone", lambda: f"0{n_digits(2)} {n_digits(3)} {n_digits(4)}", ("Tel. ", "phone no. ", "fax ")),
        ("account", lambda: f"{rng.choice(('DE', 'NL', 'ES'))}{n_digits(2)} {n_digits(4)} {n_digits(4)} {n_digits(4)} {n_digits(4)}", ("IBAN ", "pay to ", "Konto ")),
        ("device", lambda: ":".join(hexes(2) for _ in range(6)), ("eth0 ", "lladdr ", "device ")),
        ("identity", lambda: f"{n_digits(3)}-{n_digits(2)}-{n_digits(4)}", ("SSN ", "Social Security No. ")),
        ("secret", lambda: hexes(rng.choice((32, 40, 64))), ("token: ", "SECRET_KEY=", "password = '")),
        ("secret", lambda: mixed(rng.randint(28, 60)), ("api_key: ", "Authorization: Bearer ", "key=\"")),
    )
    bad = (
        ("email", lambda: f"{name()} at {name()}.\n{name().title()}", ("we met ", "look ", "she was ")),
        ("email", lambda: f"{name()} at {name()}. {name().title()}", ("arrived ", "the end of ")),
        ("email", lambda: f"{name()} at {name()}. {name().title()}.\n{name().title()}", ("", "laughed ")),
        ("phone", lambda: n_digits(rng.choice((5, 6, 16))), ("order ", "id ", "population ")),
        ("phone", lambda: f"{n_digits(4)}-{n_digits(4)}", ("pages ", "ISSN ", "years ")),
        ("phone", lambda: f"{n_digits(4)} {n_digits(5)} {n_digits(6)}", ("values ", "rows ")),
        ("account", lambda: f"AB{n_digits(2)}{''.join(rng.choice('CDEFGH') for _ in range(8))}", ("part ", "model ")),
        ("device", lambda: "-".join(str(rng.randint(1, 31)) for _ in range(6)), ("draw ", "dates ")),
        ("identity", lambda: f"{n_digits(3)}-{n_digits(2)}-{n_digits(4)}", ("item ", "invoice ", "order no ")),
        ("secret", lambda: "-".join(name() + name() for _ in range(5)), ("see /", "slug ", "title ")),
        ("secret", lambda: "_".join(name() for _ in range(8)), ("call ", "def ")),
        ("secret", lambda: rng.choice(("-", "_", "x", "7")) * rng.randint(24, 60), ("", "line ")),
    )
    out: list[tuple[str, Span, int]] = []
    while len(out) < n:
        label = int(rng.random() < 0.5)
        kind, body, leads = rng.choice(good if label else bad)
        text = f"{name().title()} {name()} {rng.choice(leads)}"
        a = len(text)
        text += body()
        out.append((f"{text}{rng.choice((' ', '. ', chr(10), ', '))}{name()} {name()}.", (kind, a, len(text)), label))
    return out


@cache
def model() -> tuple[Trees, dict[str, float]]:
    """The trees and each kind's threshold: the least with at least PRECISION on the calibration examples."""
    learn, check = examples(11, 4000), other_examples(12, 4000)
    trees = Trees(np.array([features(t, s) for t, s, _ in learn]), np.array([y for *_, y in learn], dtype=float))
    score, label = trees.predict(np.array([features(t, s) for t, s, _ in check])), np.array([y for *_, y in check])
    kind = np.array([s[0] for _, s, _ in check])
    cut = {}
    for k in set(kind):
        mine = np.argsort(-score[kind == k])
        s, good = score[kind == k][mine], label[kind == k][mine].cumsum() / np.arange(1, (kind == k).sum() + 1)
        ok = np.flatnonzero((good >= PRECISION) & np.append(s[1:] < s[:-1], True))  # ties stay together
        cut[str(k)] = max(0.5, float(s[ok[-1]])) if len(ok) else 1.1
    return trees, cut


class Taken:
    """Disjoint spans in order, to be asked whether another one overlaps them."""

    def __init__(self, spans: list[tuple[int, int]] = ()):
        self.spans: list[tuple[int, int]] = []
        for a, b in sorted(spans):  # base spans may overlap each other
            if self.spans and a < self.spans[-1][1]:
                self.spans[-1] = (self.spans[-1][0], max(b, self.spans[-1][1]))
            else:
                self.spans.append((a, b))

    def overlaps(self, a: int, b: int) -> bool:
        k = bisect.bisect_left(self.spans, (b, 0))  # the last span that begins before b
        return k > 0 and self.spans[k - 1][1] > a

    def add(self, a: int, b: int) -> None:
        bisect.insort(self.spans, (a, b))


def added_spans(text: str, base: list[Span], trees: Trees, cut: dict[str, float]) -> list[Span]:
    """Candidates over their kind's threshold that overlap neither a base span nor a better candidate."""
    proposed = candidates(text)
    if not proposed:
        return []
    taken = Taken([(a, b) for _, a, b in base])
    proposed = [s for s in proposed if not taken.overlaps(s[1], s[2])]
    if not proposed:
        return []
    score = np.concatenate([trees.predict(np.array([features(text, s) for s in proposed[i : i + SCORED_AT_ONCE]])) for i in range(0, len(proposed), SCORED_AT_ONCE)])
    out: list[Span] = []
    chosen = Taken()
    for i in sorted(range(len(proposed)), key=lambda i: (-score[i], proposed[i][1], proposed[i][2], ORDER[proposed[i][0]])):
        kind, a, b = proposed[i]
        if score[i] >= cut[kind] and not chosen.overlaps(a, b):
            chosen.add(a, b)
            out.append(proposed[i])
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (ORDER[s[0]], s[1])))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): counts of the base kinds, the digest of the base spans, all spans (base
    and added, places in code points), how many were added and how many there are; with_text also the redacted text.

    Null ids stay null. Null texts count as empty; empty texts have no spans and the digest of the empty string. Texts are searched whole;
    repeated rows repeat; extra columns are ignored; an empty table gives an empty result."""
    common.small_text_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model())
    schema = SCHEMA + (", redacted string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, cut = sent.value
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2 + [pa.string()] * with_text
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("doc_id").to_pylist(), common.strings(batch.column("text")), strict=True):
                base = base_spans(text)
                more = added_spans(text, base, trees, cut)
                counts = [sum(k == kind for k, *_ in base) for kind in KINDS]
                row = [key, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more), len(more), len(base) + len(more)]
                rows.append([*row, redacted(text, base + more)] if with_text else row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
