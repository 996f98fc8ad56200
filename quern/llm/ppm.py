"""Language-model scoring: prediction by partial matching over bytes, with the word unigram beside it.

The PPM model is a byte-context trie of depth ORDER + 1 with escape method C and symbol exclusion: in a context seen T
times with D different successors, a successor seen c times has c / (T + D), and D / (T + D) is the escape to the next
shorter context, where symbols already offered by the longer one no longer count. Below the empty context every byte is
equally likely. A text is coded with ORDER zero bytes before it and one after it, which ends it.

The trie is a table that grows with the corpus: (gram, count), where a gram is a context with the nearest byte in
front, and the byte after it, so that a gram's prefixes are its shorter contexts. Nodes below JOINT bytes of context need
nothing but the grams that share those bytes, which one task holds (256**3 at most), and the counts of the JOINT - 1
order, of which there are 2**24 at most, so they are broadcast. No node is pruned.

Texts are read twice and never shuffled. The first pass counts grams and words, the second scores. A bounded number of the
commonest grams and words, HOT of each, goes to every task. Only what they do not cover is asked for: rare grams and words
of a document meet the tables by key, and their sums come back by document. Words are told apart by 128-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common
from quern.llm.wordruns import MIX, Words, slices

ORDER = 5
#: Bytes of context that grams of one task have in common.
JOINT = 3
#: Grams, and words, that every task knows. They are the commonest, so no key that is asked for has many rows.
HOT = 1 << 19
#: Counts that a task holds before it sends them on, and grams that are modelled together.
HELD, MODELLED_AT_ONCE = 2_000_000, 500_000
COUNT_SCHEMA = "a long, b long, n long"
#: kind 0: a document (a: doc_id, b: tokens, m: known ones, x, y: base score and score so far); 1: a word asked for (a, b:
#: its hash); 2: a gram asked for (a); m tells how often.
PART_SCHEMA = "kind int, key long, a long, b long, m long, training boolean, x double, y double"


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, their number in each text) of texts that lie one after the other in data, A-Z lower-cased."""
    raw, pad = data.tobytes().lower(), bytes(ORDER)
    ends = offsets.tolist()
    joined = np.frombuffer(pad + pad.join(raw[a:b] for a, b in zip(ends, ends[1:], strict=False)) + pad, dtype=np.uint8)
    n = len(joined) - ORDER
    codes = joined[ORDER:].astype(np.int64)
    for d in range(1, ORDER + 1):
        codes |= joined[ORDER - d : ORDER - d + n].astype(np.int64) << 8 * (ORDER + 1 - d)
    sizes = np.diff(offsets) + 1
    keep = np.ones(n, dtype=bool)
    after = np.cumsum(sizes + ORDER - 1)
    for k in range(1, ORDER):  # of the zeros after a text only the first is coded
        keep[after - k] = False
    return codes[keep], sizes


def folded(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of n (by default 1 each)."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[at], np.diff(np.append(at, len(keys))) if n is None else np.add.reduceat(n, at) if len(at) else n


class Order:
    """The nodes of one order: sorted grams with counts and, by context, total T, kinds D and X, what the next shorter
    order counts for the kinds seen here."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts.astype(float)
        contexts = grams >> 8
        self.at = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(grams) else np.zeros(0, dtype=np.int64)
        self.contexts = contexts[self.at]
        self.total = np.add.reduceat(self.counts, self.at) if len(self.at) else np.zeros(0)
        self.kinds = np.diff(np.append(self.at, len(grams))).astype(float)
        self.covered = np.zeros(len(self.at))

    def shorter(self) -> tuple[np.ndarray, np.ndarray]:
        return folded(self.grams >> 16 << 8 | self.grams & 255, self.counts)

    def below(self, other: Order) -> None:
        """Links to the next shorter order."""
        if len(self.at):
            self.covered = np.add.reduceat(other.counts[np.searchsorted(other.grams, self.grams >> 16 << 8 | self.grams & 255)], self.at)


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in the sorted table, whether it is there) of each key."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def orders(grams: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> list[Order]:
    """All orders, from the grams (sorted) of some whole JOINT contexts and the counts of order JOINT - 1 of the corpus."""
    out: list[Order] = [Order(grams, counts)]
    while len(out) <= ORDER:
        out.append(Order(*(low if len(out) == ORDER - JOINT + 1 else out[-1].shorter())))
    out.reverse()
    for k in range(1, ORDER + 1):
        out[k].below(out[k - 1])
    return out


def log10_probabilities(model: list[Order], grams: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    out = np.zeros(len(grams))
    left, longer = np.arange(len(grams)), np.full(len(grams), -1)
    for k in range(ORDER, -1, -1):
        o, mine = model[k], grams[left]
        context = mine >> 8 * (ORDER + 1 - k)
        node, seen = find(o.contexts, context)
        at, held = find(o.grams, context << 8 | mine & 255)
        total, kinds, all_kinds = (o.total[node], o.kinds[node], o.kinds[node]) if len(o.contexts) else (np.zeros(len(left)),) * 3
        if k < ORDER:
            before = longer[left]
            out_of = before >= 0
            total, kinds = total.copy(), kinds.copy()
            total[out_of] -= model[k + 1].covered[before[out_of]]
            kinds[out_of] -= model[k + 1].kinds[before[out_of]]
        offers = seen & (kinds > 0)
        whole = np.maximum(total + kinds * (all_kinds < 256), 1)
        hit, miss = offers & held, offers & ~held
        if len(o.grams):
            out[left[hit]] += np.log10(o.counts[at[hit]] / whole[hit])
        out[left[miss]] += np.log10(kinds[miss] / whole[miss])
        longer[left] = np.where(seen, node, -1)
        left = left[~hit]
    known = model[0].kinds[0] if len(model[0].kinds) else 0
    out[left] -= np.log10(256 - known) if known < 256 else 0
    return out


class Known:
    """Values by 64-bit key: a bucketed table that many keys are looked up in at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, second: np.ndarray | None = None):
        self.bits = max(10, int(len(keys)).bit_length() + 1)
        order = np.argsort(self.slot(keys), kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.second = None if second is None else second[order]
        self.first = np.searchsorted(self.slot(self.keys), np.arange((1 << self.bits) + 1)).astype(np.int32)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
        """The place of each key, -1 for none."""
        slot = self.slot(keys)
        at, end = self.first[slot].astype(np.int64), self.first[slot + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            same = self.keys[here] == keys[left]
            if second is not None:
                same &= self.second[here] == second[left]
            out[left[same]] = here[same]
            at[left] += 1
            left = left[~same]
            left = left[at[left] < end[left]]
        return out


def trained_on(doc_id: Column) -> Column:
    return common.id_remainder(doc_id, 7) != 2


def counts(training: DataFrame) -> DataFrame:
    """(a, b, n): partial counts of grams (a; b null) and of words (their hash a, b) of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: list[tuple[np.ndarray, np.ndarray]] = []
        words: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged_grams() -> tuple[np.ndarray, np.ndarray]:
            return folded(*(np.concatenate(x) for x in zip(*grams, strict=True)))

        def merged_words() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            a, b, n = (np.concatenate(x) for x in zip(*words, strict=True))
            order = np.argsort(a, kind="stable")
            a, b, n = a[order], b[order], n[order]
            at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, dtype=np.int64)
            return a[at], b[at], np.add.reduceat(n, at) if len(at) else n

        def row(a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

        for batch in batches:
            for _, data, offsets in slices(batch.column("text")):
                grams.append(folded(gram_codes(data, offsets)[0]))
                h1, h2 = Words(data, offsets).hashes.view(np.int64)
                words.append((h1, h2, np.ones(len(h1), dtype=np.int64)))
                if sum(len(x[0]) for x in grams) > HELD:
                    grams = [merged_grams()]
                    if len(grams[0][0]) > HELD // 2:
                        yield row(grams[0][0], None, grams[0][1])
                        grams = []
                if sum(len(x[0]) for x in words) > HELD:
                    words = [merged_words()]
                    if len(words[0][0]) > HELD // 2:
                        yield row(*words[0])
                        words = []
        if grams:
            a, n = merged_grams()
            yield row(a, None, n)
        if words:
            yield row(*merged_words())

    return training.select("text").mapInArrow(run, COUNT_SCHEMA)


def least_hot(table: DataFrame, hot: int) -> int:
    """A count that at most `hot` rows of the table (column n) reach."""
    scale = F.floor(F.log2("n") * 4)
    rows = {r.s: r.k for r in table.groupBy(scale.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    total = 0
    for s in sorted(rows, reverse=True):
        total += rows[s]
        if total > hot:
            return int(2 ** ((s + 1) / 4)) + 1
    return 1


def modelled(grams: DataFrame, low: Broadcast) -> DataFrame:
    """(code, p): log10 probabilities of the grams (code, n, asked) that are asked for; n is 0 for those not seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            code, n, asked = (np.concatenate(x) for x in zip(*held, strict=True))
            joint = code >> 8 * (ORDER + 1 - JOINT)
            end = len(code) if last else int(np.searchsorted(joint, joint[-1]))  # the last context may go on
            held, size = [(code[end:], n[end:], asked[end:])], len(code) - end
            code, n, asked = code[:end], n[:end], asked[:end]
            if asked.any():
                found = log10_probabilities(orders(code[n > 0], n[n > 0], low.value), code[asked])
                yield pa.RecordBatch.from_arrays([pa.array(code[asked]), pa.array(found)], names=["code", "p"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("code", "n", "asked")))
            size += batch.num_rows
            if size >= MODELLED_AT_ONCE:
                yield from flush(False)
        if held:
            yield from flush(True)

    dealt = grams.repartition(F.shiftright("code", 8 * (ORDER + 1 - JOINT))).sortWithinPartitions("code")
    return dealt.select("code", "n", "asked").mapInArrow(run, "code long, p double")


def parts(docs: DataFrame, sent: Broadcast, scale: float) -> DataFrame:
    """What the hot grams and words tell of each document, and what has to be asked for; see PART_SCHEMA."""
    model = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        grams, words = _known(model, sent)
        key = TaskContext.get().partitionId() << 33
        names = [c.split()[0] for c in PART_SCHEMA.split(", ")]

        def asked(kind: int, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort((b, a, text))
            text, a, b = text[order], a[order], b[order]
            new = np.concatenate([[True], (np.diff(text) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)])[: len(a)]
            at = np.flatnonzero(new)
            n = len(at)
            values = [np.full(n, kind, dtype=np.int32), key + text[at], a[at], b[at], np.diff(np.append(at, len(a)))]
            return pa.RecordBatch.from_arrays([*map(pa.array, values), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())], names=names)

        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                m = len(offsets) - 1
                found = Words(data, offsets)
                h1, h2 = found.hashes.view(np.int64)
                at = words.find(h1, h2)
                hit = at >= 0
                n_words = np.bincount(found.text_of, minlength=m)
                n_known = np.bincount(found.text_of[hit], minlength=m)
                base = np.bincount(found.text_of[hit], np.log10(words.values[at[hit]] + 1.0), m)
                yield asked(1, found.text_of[~hit], h1[~hit], h2[~hit])
                codes, sizes = gram_codes(data, offsets)
                at = grams.find(codes)
                hit = at >= 0
                text = np.repeat(np.arange(m), sizes)
                score = np.bincount(text[hit], grams.values[at[hit]], m)
                yield asked(2, text[~hit], codes[~hit], np.zeros(int((~hit).sum()), dtype=np.int64))
                columns = [pa.array(np.zeros(m, dtype=np.int32)), pa.array(key + np.arange(m)), batch.column("doc_id").slice(first, m), pa.array(n_words + 1), pa.array(n_known), batch.column("training").slice(first, m)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(base - (n_words + 1) * scale, pa.float64()), pa.array(score, pa.float64())], names=names)
                key += m

    return docs.select("doc_id", "training", "text").mapInArrow(run, PART_SCHEMA)


def _known(model: str, sent: Broadcast) -> tuple[Known, Known]:
    """The worker's tables of a model."""

    def tables() -> tuple[Known, Known]:
        codes, p, h1, h2, c = sent.value
        return Known(codes, p), Known(h1, c, h2)

    return common.held(model, tables)


def _arrays(df: DataFrame) -> list[np.ndarray]:
    """The columns of a small table."""
    table = df.toArrow()
    return [table.column(c).to_numpy().astype(np.float64 if t == "double" else np.int64) for c, t in df.dtypes]


def score(docs: DataFrame, training: Column | None = None, hot: int = HOT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    training tells which rows are learned from (by default those of trained_on, where a null id counts as an empty one).
    Null text is empty: one token, the end. Without training rows all counts are 0. Repeated rows, of one id or of none,
    count as often as they occur and each has its row; extra columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    common.small_text_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("training", F.coalesce(trained_on(F.col("doc_id")) if training is None else training, F.lit(False)))
    counted = common.stored(counts(docs.where("training")), "counts")
    grams = common.stored(counted.where("b is null").groupBy(F.col("a").alias("code")).agg(F.sum("n").alias("n")), "grams")
    words = common.stored(counted.where("b is not null").groupBy("a", "b").agg(F.sum("n").alias("n")), "words")
    totals = words.agg(F.count(F.lit(1)).alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    n_train = docs.where("training").count()
    tokens, kinds = totals.n + n_train, totals.kinds + (n_train > 0)
    scale = float(np.log10(tokens + kinds + 1))
    short = F.shiftleft(F.shiftright("code", 8 * (ORDER + 2 - JOINT)), 8).bitwiseOR(F.col("code").bitwiseAND(255))
    low = _arrays(grams.groupBy(short.alias("code")).agg(F.sum("n").alias("n")).orderBy("code"))  # 2**24 rows at most
    low_sent = spark.sparkContext.broadcast(tuple(low))
    common_grams = modelled(grams.withColumn("asked", F.col("n") >= least_hot(grams, hot)), low_sent)
    common_words = words.where(F.col("n") >= least_hot(words, hot))
    sent = spark.sparkContext.broadcast((*_arrays(common_grams), *_arrays(common_words)))
    found = common.stored(parts(docs, sent, scale), "parts")
    asked_words = found.where("kind = 1").select("key", "a", "b", "m")
    of_words = asked_words.join(words, ["a", "b"]).select("key", F.col("m").alias("known"), (F.col("m") * F.log10(F.col("n") + 1)).alias("x"), F.lit(0.0).alias("y"))
    asked_grams = found.where("kind = 2").select("key", F.col("a").alias("code"), "m")
    wanted = grams.withColumn("asked", F.lit(False)).unionByName(asked_grams.select("code").distinct().withColumns({"n": F.lit(0).cast("long"), "asked": F.lit(True)}))
    rare = modelled(wanted.groupBy("code").agg(F.sum("n").alias("n"), F.bool_or("asked").alias("asked")), low_sent)
    of_grams = asked_grams.join(rare, "code").select("key", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("x"), (F.col("m") * F.col("p")).alias("y"))
    documents = found.where("kind = 0").select("key", F.col("m").alias("known"), "x", "y", F.col("a").alias("doc_id"), F.col("b").alias("n_tokens"), "training")
    sums = documents.unionByName(of_words.unionByName(of_grams), allowMissingColumns=True).groupBy("key")
    # a key has one document row, whose end is a token of count n_train
    rows = sums.agg(F.max("doc_id").alias("doc_id"), F.max("training").alias("training"), F.max("n_tokens").alias("n_tokens"), F.sum("known").alias("n_known"), F.sum("x").alias("x"), F.sum("y").alias("score"))
    return rows.select(
        "doc_id",
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.lit(int(n_train > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("x") + F.lit(float(np.log10(n_train + 1)))).alias("base_score"),
        "score",
    )
