"""Spelling variants: words one edit apart, by a positional q-gram inverted index with a count filter.

The vocabulary is counted first, all in the JVM. Two words one edit apart have at least max(lengths) - 3 of their bigrams in
common (an edit touches two), in the same order, at places that differ by the words' difference in length at most.

The index is dealt out by prefixes. With a word's bigrams ordered from rare to frequent, near words share SHARED of the first
SHARED + 2 of either, so a word goes to one cell for each choice of SHARED of its first bigrams: to the cells of its own
length as a word to be found, and to those of one letter less as a word that asks. The order needs the bigrams' counts, a
table of at most 2**16 rows as the alphabet has 256 letters. A cell of more than CELL_WORDS words is cut into blocks by the
words' hashes, and whoever asks goes to each.

Within a cell, postings (bigram, place) hold the words in order. A word that asks merges the postings of its own bigrams at
the places that its length allows, for many cells and words at once (a sort of the postings' runs), and those that
it meets as often as the bound demands are compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

#: Runs of these letters are words; all have code points below 256.
LETTERS = r"A-Za-zÀ-ÿ"
#: A run whose hash this divides loses a letter.
LOSSY = 199
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 6, 5, 5
#: Bigrams that two near words share at least at LEAST_LENGTH, and that name a cell.
SHARED = 3
#: Bigrams of a word among which SHARED common ones lie: all but LEAST_LENGTH - 1 - SHARED may be met only further on.
PREFIX = SHARED + 2
CHOICES = np.array(list(combinations(range(PREFIX), SHARED)))
#: Words to be found in a cell, beyond which it is cut into blocks.
CELL_WORDS = 4096
#: Rows of cells, and words met in postings, that are handled together.
ROWS_AT_ONCE, MET_AT_ONCE = 1 << 15, 1 << 21
FOUND, ASKS_SAME, ASKS_LONGER = 0, 1, 2
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def vocabulary(docs: DataFrame, lossy: int = LOSSY, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words of at least `length` letters that occur at least `count` times in docs (doc_id, text).

    Words are maximal runs of letters with A-Z lower-cased. A run whose crc32 of "<doc_id>:<word>" is divisible by `lossy` loses
    the letter at that crc modulo its length. A null id counts as empty, a null text has no words."""
    # shorter runs cannot become long enough
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run")).withColumn("_run", common.ascii_lower(F.col("_run")))
    h = F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    shortened = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    words = words.withColumn("_h", h).select(F.when(F.col("_h") % lossy == 0, shortened).otherwise(F.col("_run")).alias("word"))
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def _bigrams(letters: np.ndarray) -> np.ndarray:
    """The bigrams of Latin-1 bytes as numbers below 2**16."""
    wide = letters.astype(np.int64)
    return wide[:-1] << 8 | wide[1:]


def ranks(words: DataFrame) -> np.ndarray:
    """The place of each of the 2**16 bigrams when they are ordered from rare to frequent among the words (word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, dtype=np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                np.add.at(counts, _bigrams(np.frombuffer(word.encode("latin-1"), dtype=np.uint8)), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bigram", "n"])

    found = words.select("word").mapInArrow(run, "bigram long, n long").groupBy("bigram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 << 16, dtype=np.int64)
    for r in found:
        counts[r.bigram] = r.n
    out = np.empty(1 << 16, dtype=np.int64)
    out[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16)
    return out


def cells(words: DataFrame, rank: np.ndarray) -> DataFrame:
    """(cell, kind, word, n, first) of words (word, n): the word's rows for the cells of its own length (kind FOUND) and of
    one letter less (ASKS_LONGER). first holds the ranks of its first bigrams. A choice that occurs twice in a word counts once."""
    most = (1 << 15) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in common.batches_of(iter(range(batch.num_rows)), 2048):
                word = batch.column("word").take(pa.array(rows)).to_pylist()
                first = np.stack([np.sort(rank[_bigrams(np.frombuffer(w.encode("latin-1"), dtype=np.uint8))])[:PREFIX] for w in word])
                chosen = first[:, CHOICES]
                base = chosen[:, :, 0] << 32 | chosen[:, :, 1] << 16 | chosen[:, :, 2]
                base = np.sort(base, axis=1)
                fresh = np.concatenate([np.ones((len(word), 1), dtype=bool), base[:, 1:] != base[:, :-1]], axis=1)
                owner = np.repeat(np.arange(len(word)), fresh.sum(axis=1))
                length = np.array([min(len(w), most) for w in word])[owner]
                own, less = base[fresh] | length << 48, base[fresh] | length - 1 << 48
                both = np.concatenate([owner, owner])
                taken = pa.array(np.array(rows)[both])
                code = pa.array([x.tobytes() for x in first.astype(np.uint16)], pa.binary()).take(pa.array(both))
                kind = pa.array(np.repeat([FOUND, ASKS_LONGER], len(owner)).astype(np.int8))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own, less])), kind, batch.column("word").take(taken), batch.column("n").take(taken), code], names=["cell", "kind", "word", "n", "first"])

    return words.select("word", "n").mapInArrow(run, "cell long, kind byte, word string, n long, first binary")


def in_blocks(rows: DataFrame) -> DataFrame:
    """rows (cells) with block: 0, but for cells of more than CELL_WORDS words to be found. There such a word is in one block and
    asks in all."""
    sizes = rows.where(F.col("kind") == FOUND).groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL_WORDS)
    large = common.stored(sizes.select("cell", F.ceil(F.col("size") / CELL_WORDS).cast("int").alias("blocks")), "large-cells")
    if large.isEmpty():
        return rows.withColumn("block", F.lit(0))
    sized = rows.join(large, "cell", "left")
    own = F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    same = sized.where(F.col("kind") == FOUND)
    out = same.withColumn("block", own)
    again = same.where("blocks is not null").withColumns({"kind": F.lit(ASKS_SAME).cast("byte"), "block": F.explode(every)})
    longer = sized.where(F.col("kind") == ASKS_LONGER).withColumn("block", F.explode(every))
    return out.unionByName(again).unionByName(longer).drop("blocks")


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter inserted, deleted or replaced makes a of b."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + (len(a) == len(b)) :]


class Block:
    """Rows of whole cells, or of parts that have all their words to be found: number tells cells and blocks apart, cell
    is the choice of ranks (and the length, above them), first has the ranks of each word's first bigrams."""

    def __init__(self, number: np.ndarray, cell: np.ndarray, kind: np.ndarray, words: list[bytes], first: np.ndarray):
        self.number, self.kind, self.words, self.first = number, kind, words, first
        self.chosen = np.stack([cell >> 32 & 0xFFFF, cell >> 16 & 0xFFFF, cell & 0xFFFF], axis=1)
        self.lengths = np.array([len(w) for w in words])
        letters = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(self.lengths)
        grams = np.delete(_bigrams(letters), ends[:-1] - 1)
        self.owner = np.repeat(np.arange(len(words)), self.lengths - 1)
        self.place = np.arange(len(grams)) - np.repeat(ends - self.lengths - np.arange(len(words)), self.lengths - 1)
        self.gram = grams

    def keys(self, rows: np.ndarray, shift: int) -> np.ndarray:
        """A number for (cell, bigram, place - shift) of the given bigrams. Equal numbers of unlike ones only cost a comparison."""
        with np.errstate(over="ignore"):
            mixed = self.number[self.owner[rows]].astype(np.uint64) * MIX[0] ^ self.gram[rows].astype(np.uint64) * MIX[1] ^ (self.place[rows] - shift).astype(np.uint64) * MIX[2]
            return (mixed ^ mixed >> np.uint64(29)) * MIX[0]

    def met(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows that ask, rows that they meet often enough)."""
        posted = np.flatnonzero(self.kind[self.owner] == FOUND)
        key = self.keys(posted, 0)
        order = np.argsort(key, kind="stable")
        key, holder = key[order], self.owner[posted][order]
        # words to be found ask those behind them in the same postings
        spot = np.empty(len(order), dtype=np.int64)
        spot[order] = np.arange(len(order))
        runs = [(self.owner[posted], spot + 1, np.searchsorted(key, key[spot], side="right"))]
        for asks, shifts in ((ASKS_SAME, (0,)), (ASKS_LONGER, (0, 1))):
            grams = np.flatnonzero(self.kind[self.owner] == asks)
            for shift in shifts:
                wanted = self.keys(grams, shift)
                runs.append((self.owner[grams], np.searchsorted(key, wanted, side="left"), np.searchsorted(key, wanted, side="right")))
        who, lo, hi = (np.concatenate(x) for x in zip(*runs, strict=True))
        some = np.flatnonzero(hi > lo)
        some = some[np.argsort(who[some], kind="stable")]
        who, lo, size = who[some], lo[some], (hi - lo)[some]
        total = np.concatenate([[0], np.cumsum(size)])
        start = 0
        while start < len(who):
            end = int(np.searchsorted(total, total[start] + MET_AT_ONCE, side="right")) - 1
            if end < len(who):  # whole words only
                end = int(np.searchsorted(who, who[max(end, start)], side="left"))
            if end <= start:
                end = int(np.searchsorted(who, who[start], side="right"))
            n = size[start:end]
            at = np.repeat(lo[start:end], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            pair, times = np.unique(np.repeat(who[start:end], n) * len(self.words) + holder[at], return_counts=True)
            a, b = pair // len(self.words), pair % len(self.words)
            enough = times >= np.maximum(self.lengths[a], self.lengths[b]) - 3
            yield a[enough], b[enough]
            start = end

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that are one edit apart, each in the first of the cells that the two words share."""
        left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for a, b in self.met():
            first = self.are_first(a, b)
            a, b = a[first], b[first]
            near = np.array([one_edit(self.words[i], self.words[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)], dtype=bool)
            left.append(a[near])
            right.append(b[near])
        return np.concatenate(left), np.concatenate(right)

    def are_first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no rarer choice is common to the two words: their first common ranks are those of the cell."""
        first_a, first_b, chosen = self.first[a], self.first[b], self.chosen[a]
        out, each = np.ones(len(a), dtype=bool), np.arange(len(a))
        x, y, found = (np.zeros(len(a), dtype=np.int64) for _ in range(3))
        for _ in range(2 * PREFIX):
            go = (x < PREFIX) & (y < PREFIX) & (found < SHARED)
            i, j = first_a[each, np.minimum(x, PREFIX - 1)], first_b[each, np.minimum(y, PREFIX - 1)]
            same = go & (i == j)
            out &= ~same | (chosen[each, np.minimum(found, SHARED - 1)] == i)
            x, y, found = x + (go & (i <= j)), y + (go & (j <= i)), found + same
        return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of words (word, n): each pair one edit apart, in both directions."""
    rows = in_blocks(common.stored(cells(words, ranks(words)), "cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cell, block, kind = (table.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "block", "kind"))
            edge = (np.diff(cell) != 0) | (np.diff(block) != 0)
            number = np.concatenate([[0], np.cumsum(edge)])
            first = np.frombuffer(b"".join(table.column("first").to_pylist()), dtype=np.uint16).reshape(-1, PREFIX).astype(np.int64)
            left, right = Block(number, cell, kind, [w.encode("latin-1") for w in table.column("word").to_pylist()], first).near()
            word, n = table.column("word"), table.column("n")
            a, b = pa.array(np.concatenate([left, right])), pa.array(np.concatenate([right, left]))
            yield pa.RecordBatch.from_arrays([word.take(a), n.take(a), word.take(b), n.take(b)], names=["word", "n", "near", "near_n"])
            # the last cell may go on: its words to be found stay
            open_ = np.flatnonzero((number == number[-1]) & (kind == FOUND)) if not last else []
            held = [table.take(pa.array(open_, pa.int64()))] if len(open_) else []
            size = 0

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= ROWS_AT_ONCE:
                yield from flush(False)
        if size:
            yield from flush(True)

    dealt = rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return dealt.select("cell", "block", "kind", "word", "n", "first").mapInArrow(run, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): where forms lead, by pointer doubling. A form is more frequent than its word, so
    there is no circle, and a chain is no longer than a logarithm of the largest count."""
    up = common.stored(forms.select("word", F.col("form").alias("root")), "up")
    while True:
        step = up.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        new = common.stored(up.join(step, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_moved")), "up")
        if new.where("_moved").isEmpty():
            return new.drop("_moved")
        up = new.drop("_moved")


def group_spellings(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the vocabulary of docs (doc_id, text).

    n_near counts the words one edit away. form is the most frequent of them (ties: the smallest in code-point order), if it is
    FORM_FACTOR times as frequent as the word, else null, and form_n its count; root is where forms lead from the word, itself
    without one. Rows that repeat count again. Extra columns are ignored; without words the result is empty."""
    common.small_text_batches(docs.sparkSession)
    words = common.stored(vocabulary(docs), "words")
    # pairs that met in several parts of a large cell are rows that repeat
    pairs = common.stored(near_words(words).distinct(), "pairs")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    found = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fit = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    named = words.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fit, F.col("best.near")).alias("form"), F.when(fit, -F.col("best.less")).alias("form_n"))
    named = common.stored(named, "named")
    ends = roots(named.where("form is not null").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
