"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A CGK walk turns a string into one that can be compared position by position: at step j it writes the byte it stands on
and moves on or stays, as a random bit for (j, byte) says. Strings a few edits apart fall back into step after each
edit, so edit distance becomes a small Hamming distance. Bit-sampling LSH then draws some steps of the walk as a key; a
document window and a benchmark window that share any of the keys are candidates, and the item is held against the text
around the window by exact (semi-global) edit distance.

Windows start where both sides choose the same words: a word is an anchor if its hash is least in some run of
ANCHOR_WORDS words. Any such run that a document shares with an item therefore holds an anchor of both, at the same
place of the passage, and a whole item has several, each with REPEATS keys: a leak is missed only if all of them fail.

An item too short for such windows is cut into one piece more than it may have edits, so that one piece stands unedited
in any occurrence: every place of a piece is a candidate, none is missed. Items of any size have to stand at word boundaries:
a letter or digit that adjoins counts as an edit.

Each document is judged in one task against the broadcast item windows; no text is shuffled and no pair is built.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

ANCHOR_WORDS = 5
#: Steps of a walk; it covers about half as many bytes.
STEPS = 72
WALKS, KEYS_PER_WALK, KEY_STEPS = 2, 8, 6
REPEATS = WALKS * KEYS_PER_WALK
#: Steps at the start that hold the anchor itself and are not drawn.
SKIPPED_STEPS = 12
#: Share of a walk's steps in which two windows with a common key may differ and still be candidates; unrelated text
#: differs in about nine tenths of them.
WALK_SHARE = 0.4
#: Bytes that an item has to hold after an anchor.
TAIL = 44
#: Shorter items (normalised bytes), and items without an anchor that fits, are looked for by pieces.
SHORT_ITEM = 80
#: Edits that an item may be away, as a share of its bytes.
EDIT_SHARE = 0.15
#: Bytes of items that one pass over the documents carries; a larger benchmark takes several passes. The index takes some
#: 70 times as much in each Python worker, so about 140 MB.
ITEM_BYTES_A_PASS = 2 << 20
TEXTS_AT_ONCE, ANCHORS_AT_ONCE = 256, 1 << 15
SCHEMA = "doc_id long, item_id long, distance int, item_bytes int, word_start long, words long"
#: Text bytes that are compared with the pieces of short items together.
PLACES_AT_ONCE = 1 << 20
#: ASCII bytes that no word is made of become spaces.
TO_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
WORD_BYTE = rb"[0-9a-z\x80-\xff]"
MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> bytes:
    """UTF-8, A-Z lower-cased, runs of ASCII white space as one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").lower().split())


def edit_distance_within(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of the whole pattern in a part of text, or None beyond `most` edits.

    Bit-parallel dynamic programme: a column of the edit matrix is two integers of len(pattern) bits."""
    m = len(pattern)
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, where = m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        across = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(across | up) & full
        minus = up & across
        if score < best:
            best, where = score, j + 1
    return (best, where) if best <= most else None


class Sampler:
    """The walks' random bits and the steps drawn for each key; equal in every task."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, size=(WALKS, STEPS, 256), dtype=np.int64)
        self.drawn = [[np.sort(rng.choice(np.arange(SKIPPED_STEPS, STEPS), KEY_STEPS, replace=False)) for _ in range(KEYS_PER_WALK)] for _ in range(WALKS)]

    def keys(self, buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start the walks' bytes (WALKS, STEPS, n) and REPEATS keys of the bytes at the steps drawn. buffer ends
        in padding."""
        out = np.zeros((REPEATS, len(starts)), dtype=np.uint64)
        trace = np.zeros((WALKS, STEPS, len(starts)), dtype=np.uint8)
        for walk in range(WALKS):
            needed: dict[int, list[int]] = {}
            for k, steps in enumerate(self.drawn[walk]):
                for s in steps.tolist():
                    needed.setdefault(s, []).append(walk * KEYS_PER_WALK + k)
            at = starts.astype(np.int64)
            for step in range(STEPS):
                seen = trace[walk, step] = buffer[at]
                for key in needed.get(step, ()):
                    out[key] = out[key] << np.uint64(8) | seen
                at += self.moves[walk, step][seen]
        return trace, out


def anchors(buffer: np.ndarray, word_starts: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Indices of words whose hash is least in some run of ANCHOR_WORDS words of one text; all words of shorter texts."""
    n, w = len(word_starts), ANCHOR_WORDS
    if not n:
        return np.zeros(0, dtype=np.int64)
    eight = np.ndarray(shape=(len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
    hashes = eight[word_starts] * MIX
    hashes = (hashes ^ hashes >> np.uint64(29)) * MIX >> np.uint64(33) | np.uint64(1)
    chosen = np.bincount(text_of)[text_of] < w
    if n >= w:
        runs = n - w + 1
        least = hashes[:runs].copy()
        for k in range(1, w):
            np.minimum(least, hashes[k : k + runs], out=least)
        least[text_of[:runs] != text_of[w - 1 :]] = 0
        for k in range(w):
            chosen[k : k + runs] |= least == hashes[k : k + runs]
    return np.flatnonzero(chosen)


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One padded buffer of all texts: (buffer, each text's place, word starts, text of each word)."""
    gap = bytes(STEPS + 8)
    joined = b"".join(x for t in texts for x in (b" ", t, gap))
    buffer = np.frombuffer(joined, dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    places = np.concatenate([[0], np.cumsum(sizes + 1 + len(gap))[:-1]]) + 1 if len(texts) else np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(buffer == 32) + 1
    starts = starts[buffer[starts] != 0]
    return buffer, places, starts, np.searchsorted(places, starts, side="right") - 1


def whole_words(item: bytes) -> re.Pattern[bytes]:
    """The item where no word goes on beyond either end of it."""
    before = rb"(?<!" + WORD_BYTE + rb")" if re.match(WORD_BYTE, item[:1]) else b""
    behind = rb"(?!" + WORD_BYTE + rb")" if re.match(WORD_BYTE, item[-1:]) else b""
    return re.compile(before + re.escape(item) + behind)


class Pieces:
    """The pieces of short items, by length: one more than the item's edits, 7 bytes at most while EDIT_SHARE is 0.15."""

    def __init__(self, items: list[tuple[int, bytes]]):
        """items: (number, normalised text)."""
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        for k, text in items:
            parts = int(EDIT_SHARE * len(text)) + 1
            cuts = [j * len(text) // parts for j in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                b = min(b, a + 8)
                by_length.setdefault(b - a, []).append((int.from_bytes(text[a:b], "little"), k, a))
        self.tables = {}
        for length, found in by_length.items():
            found.sort()
            values = np.array([x[0] for x in found], dtype=np.uint64)
            bits = max(16, int(len(values) * 16).bit_length())
            known = np.zeros(1 << bits, dtype=bool)
            known[(values * MIX >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.tables[length] = values, np.array([x[1] for x in found], dtype=np.int64), np.array([x[2] for x in found], dtype=np.int64), bits, known

    def candidates(self, buffer: np.ndarray, places: np.ndarray) -> dict[int, dict[int, set[int]]]:
        """text -> item -> places in the text where the item would begin."""
        out: dict[int, dict[int, set[int]]] = {}
        eight = np.ndarray(shape=(max(0, len(buffer) - 7),), dtype="<u8", buffer=buffer, strides=(1,))
        for length, (values, item, offset, bits, known) in self.tables.items():
            mask = np.uint64((1 << 8 * length) - 1)
            for i in range(0, len(eight), PLACES_AT_ONCE):
                here = eight[i : i + PLACES_AT_ONCE] & mask
                maybe = np.flatnonzero(known[(here * MIX >> np.uint64(64 - bits)).astype(np.int64)])
                low = np.searchsorted(values, here[maybe], side="left")
                times = np.searchsorted(values, here[maybe], side="right") - low
                at = np.repeat(maybe, times) + i
                which = np.repeat(low, times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                text = np.searchsorted(places, at, side="right") - 1
                begin = at - places[text] - offset[which]
                for t, k, b in zip(text.tolist(), item[which].tolist(), begin.tolist(), strict=True):
                    if t >= 0:
                        out.setdefault(t, {}).setdefault(k, set()).add(b)
        return out


class Items:
    """A pass's benchmark windows by key."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = items
        self.sampler = Sampler()
        long = [k for k, (_, t) in enumerate(items) if len(t) >= SHORT_ITEM]
        buffer, places, starts, text_of = layout([items[k][1] for k in long])
        chosen = anchors(buffer, starts, text_of)
        offset = starts[chosen] - places[text_of[chosen]] if len(chosen) else np.zeros(0, dtype=np.int64)
        sizes = np.array([len(items[k][1]) for k in long], dtype=np.int64)
        fits = sizes[text_of[chosen]] - offset >= TAIL if len(chosen) else np.zeros(0, dtype=bool)
        anchored = {long[i] for i in np.unique(text_of[chosen[fits]]).tolist()}
        self.short = {k for k, (_, t) in enumerate(items) if t and k not in anchored}
        self.pieces = Pieces([(k, items[k][1]) for k in sorted(self.short)])
        self.patterns = {k: whole_words(t) for k, (_, t) in enumerate(items) if t}
        # the first word of an item is always among its windows
        chosen = np.union1d(chosen[fits], np.flatnonzero(np.diff(text_of, prepend=-1)))
        offset = starts[chosen] - places[text_of[chosen]] if len(chosen) else np.zeros(0, dtype=np.int64)
        self.item = np.array(long, dtype=np.int64)[text_of[chosen]] if len(chosen) else np.zeros(0, dtype=np.int64)
        self.offset = offset
        self.trace, keys = self.sampler.keys(buffer, starts[chosen])
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, self.order, axis=1)
        self.bits = max(16, int(max(1, len(chosen)) * 16).bit_length())
        self.filters = np.zeros((REPEATS, 1 << self.bits), dtype=bool)
        for k in range(REPEATS):
            self.filters[k, self.slot(keys[k])] = True

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, texts: list[bytes]) -> dict[int, dict[int, set[int]]]:
        """text -> item -> places in the text where the item would begin."""
        buffer, places, starts, text_of = layout(texts)
        out: dict[int, dict[int, set[int]]] = {}
        chosen = anchors(buffer, starts, text_of)
        for i in range(0, len(chosen), ANCHORS_AT_ONCE):
            part = chosen[i : i + ANCHORS_AT_ONCE]
            trace, keys = self.sampler.keys(buffer, starts[part])
            for k in range(REPEATS):
                maybe = np.flatnonzero(self.filters[k][self.slot(keys[k])])
                if not len(maybe):
                    continue
                low = np.searchsorted(self.sorted[k], keys[k][maybe], side="left")
                times = np.searchsorted(self.sorted[k], keys[k][maybe], side="right") - low
                mine = np.repeat(maybe, times)
                window = self.order[k, np.repeat(low, times) + np.arange(len(mine)) - np.repeat(np.cumsum(times) - times, times)]
                walk = k // KEYS_PER_WALK
                for j in range(0, len(mine), ANCHORS_AT_ONCE):
                    a, b = mine[j : j + ANCHORS_AT_ONCE], window[j : j + ANCHORS_AT_ONCE]
                    near = (trace[walk][:, a] != self.trace[walk][:, b]).mean(axis=0) <= WALK_SHARE
                    a, b = a[near], b[near]
                    text = text_of[part[a]]
                    place = starts[part[a]] - places[text] - self.offset[b]
                    for t, item, begin in zip(text.tolist(), self.item[b].tolist(), place.tolist(), strict=True):
                        out.setdefault(t, {}).setdefault(item, set()).add(begin)
        return out

    def leaks(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end) of each item found in a text: its nearest occurrence, the first on ties."""
        found = self.candidates(texts) if len(self.item) else {}
        if self.short:
            buffer, places, _, _ = layout(texts)
            for i, more in self.pieces.candidates(buffer, places).items():
                for k, begins in more.items():
                    found.setdefault(i, {}).setdefault(k, set()).update(begins)
        for i, text in enumerate(texts):
            here = sorted(found.get(i, {}).items())
            spaced = b" " + text.translate(TO_SPACES) + b" " if here and self.patterns else b""
            for k, begins in here:
                item = self.items[k][1]
                at = m.start() if (m := self.patterns[k].search(text)) else -1
                if at >= 0:
                    yield i, k, 0, at, at + len(item)
                    continue
                most, best, done = int(EDIT_SHARE * len(item)), None, []
                if not most:
                    continue
                for begin in sorted(begins):
                    if done and begin - done[-1] <= most // 2:
                        continue
                    done.append(begin)
                    low, high = max(0, begin - 2 * most), min(len(text), begin + len(item) + 2 * most)
                    if not edit_distance_within(b" " + item.translate(TO_SPACES) + b" ", spaced[low : high + 2], most):
                        continue
                    match = edit_distance_within(item, text[low:high], most)
                    if match and (best is None or match[0] < best[0]):
                        best = (match[0], max(0, low + match[1] - len(item)), low + match[1])
                if best:
                    yield i, k, *best


def leaks(docs: DataFrame, benchmark: DataFrame, item_bytes_a_pass: int = ITEM_BYTES_A_PASS) -> DataFrame:
    """Rows (doc_id, item_id, distance, item_bytes, word_start, words): benchmark items found in docs (doc_id, text).

    An item counts as found if at most EDIT_SHARE of its normalised bytes have to be edited to make it a part of the
    document's normalised text. One row for each document row and item, with the nearest occurrence's first word and
    number of words. Null and blank items are ignored; a letter or digit that
    adjoins an item counts as an edit. Null
    and empty texts hold nothing; repeated rows repeat; extra columns are ignored; empty tables give
    an empty result. The benchmark's size is measured first, and a large one is searched for in several passes."""
    common.small_text_batches(docs.sparkSession)
    out = None
    for items in _passes(benchmark, item_bytes_a_pass):
        found = _one_pass(docs, items)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def _passes(benchmark: DataFrame, item_bytes_a_pass: int) -> Iterator[list[tuple[int, bytes]]]:
    """(item_id, normalised text) of the items of each pass, whose size is measured before they are fetched."""
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-size // item_bytes_a_pass)
    for k in range(passes):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        yield [(r.item_id, normalised(r.text)) for r in part]


def _index(number: str, sent: Broadcast) -> Items:
    """The worker's index of a pass."""
    return common.held(number, lambda: Items(sent.value))


def _one_pass(docs: DataFrame, items: list[tuple[int, bytes]]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    number = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(number, sent)
        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), [normalised(t) for t in common.strings(batch.column("text"))]
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                part = texts[i : i + TEXTS_AT_ONCE]
                rows = [(keys[i + d], index.items[k][0], distance, len(index.items[k][1]), part[d][:start].count(b" "), part[d][start:end].strip().count(b" ") + 1) for d, k, distance, start, end in index.leaks(part)]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, item_bytes_a_pass: int = ITEM_BYTES_A_PASS) -> DataFrame:
    """docs without the documents that hold a benchmark item; all columns, whole texts. Each row is judged by its own text,
    so rows that share an id, or have none, are told apart; equal rows share a fate. No row is shuffled."""
    common.small_text_batches(docs.sparkSession)
    for items in _passes(benchmark, item_bytes_a_pass):
        docs = docs.where(common.text_flags(_clean(docs, items), F.col("text")))
    return docs


def _clean(docs: DataFrame, items: list[tuple[int, bytes]]) -> Callable[[], Callable[[list[str | None]], list[bool]]]:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    number = uuid.uuid4().hex

    def judge() -> Callable[[list[str | None]], list[bool]]:
        index = _index(number, sent)

        def clean(texts: list[str | None]) -> list[bool]:
            out = [True] * len(texts)
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                for d, *_ in index.leaks([normalised(t or "") for t in texts[i : i + TEXTS_AT_ONCE]]):
                    out[i + d] = False
            return out

        return clean

    return judge
