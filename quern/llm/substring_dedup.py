"""Substring deduplication by sliding sentence spans.

Words are what lies between ASCII white space, compared with A-Z lower-cased. A sentence ends after a word that ends in
. ! or ?, and at line feeds. A sentence of more than RUN_WORDS words is cut further, after each word whose hash is least in
some run of RUN_WORDS of its words, ties included. So no part has more than RUN_WORDS words, with or without marks, and
beyond the RUN_WORDS words at either end of a passage its cuts are the same wherever it stands: 51 words hold a whole
span. The span at a part is the shortest run from it of at least SPAN_PARTS parts and SPAN_WORDS words. In a text, a span
that overlaps the first one equal to it is none, lest a run of one word removes its own first occurrence. Spans are
hashed and joined over all documents; the first occurrence of each (least doc_id, then text, then place) stays, and parts
that any other occurrence of a span covers are removed.

A passage that two documents share, with other text glued to either end, loses at most its cut-off first and last
words to the hashes; all spans inside it are found. A batch of texts is cut and hashed as arrays, without a loop over words:
hashes are polynomials modulo 2**64 over random values for bytes, then words, taken from prefix sums (two of them, 128 bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common
from quern.llm.wordruns import LANES, WORD_BASES, Words, run_hashes, slices

SPAN_PARTS = 2
SPAN_WORDS = 20
RUN_WORDS = 8
SPAN_SCHEMA = "h1 long, h2 long, id long, digest long, place int, parts int"
REMOVED_SCHEMA = "doc_id long, sentences int, removed int, first_doc_ids array<long>, text string"
#: Spans with at least one in so many of all occurrences are joined by broadcast: so many at most.
HEAVY_SHARE = 2000
#: Stands for a missing doc_id; rows without an id come last.
NO_ID = (1 << 63) - 1
ENDS = np.isin(np.arange(256), np.frombuffer(b".!?", dtype=np.uint8))

class Cut(Words):
    """The words and parts of texts that lie one after the other in data, with spans at the parts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        super().__init__(data, offsets)
        n = len(self.starts)
        last = np.ones(n, dtype=bool)
        if n:
            lines = np.append(np.flatnonzero(data == 10), len(data))
            last[:-1] = (self.text_of[1:] != self.text_of[:-1]) | ENDS[data[self.ends[:-1] - 1]] | (lines[np.searchsorted(lines, self.ends[:-1])] < self.starts[1:])
        last |= self._cuts(last)
        #: first and last word of each part, and its text
        self.final = np.flatnonzero(last)
        self.first = np.concatenate([[0], self.final[:-1] + 1]).astype(np.int64) if n else self.final
        self.part_text = self.text_of[self.first]
        self.first_part = np.searchsorted(self.part_text, np.arange(len(offsets)))

    def _cuts(self, last: np.ndarray) -> np.ndarray:
        """The words of long sentences whose hash is least in some run of RUN_WORDS words of the sentence."""
        n, h = len(last), self.hashes[0]
        chosen = np.zeros(n, dtype=bool)
        runs = n - RUN_WORDS + 1
        if runs <= 0:
            return chosen
        sentence = np.cumsum(last) - last
        least = h[:runs].copy()
        for k in range(1, RUN_WORDS):
            np.minimum(least, h[k : k + runs], out=least)
        inside = sentence[:runs] == sentence[RUN_WORDS - 1 :]
        for k in range(RUN_WORDS):
            chosen[k : k + runs] |= inside & (h[k : k + runs] == least)
        return chosen & (np.bincount(sentence)[sentence] > RUN_WORDS)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(h1, h2, text, place, parts) of the span at each part that has one."""
        n = len(self.final)
        i = np.arange(n)
        j = np.maximum(np.searchsorted(self.final, self.first + SPAN_WORDS - 1), i + SPAN_PARTS - 1)
        has = j < n
        has[has] = self.part_text[j[has]] == self.part_text[i[has]]
        i, j = i[has], j[has]
        h1, h2 = (run_hashes(self.hashes[lane], self.first[i], self.final[j] + 1, WORD_BASES[lane]).view(np.int64) for lane in range(LANES))
        text = self.part_text[i]
        if len(i):  # a span that overlaps the text's first equal one is left out
            order = np.lexsort((i, h1, text))
            new = np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(text[order]) != 0)])
            head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            keep = np.ones(len(i), dtype=bool)
            keep[order] = new | (i[order] > j[order][head])
            i, j, h1, h2, text = i[keep], j[keep], h1[keep], h2[keep], text[keep]
        return h1, h2, text, i - self.first_part[text], j - i + 1


def cuts(column: pa.Array) -> Iterator[tuple[int, bytes, Cut]]:
    """(number of the first text, the texts' bytes, their Cut) of the slices of an Arrow column of strings."""
    for first, data, offsets in slices(column):
        yield first, data.tobytes(), Cut(data, offsets)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, id, digest): id is NO_ID for none; rows that share id and text are one document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "digest": F.xxhash64(F.coalesce("text", F.lit("")))})


def all_spans(docs: DataFrame) -> DataFrame:
    """A row for each span of keyed docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = (batch.column(c).to_numpy() for c in ("id", "digest"))
            for k, _, cut in cuts(batch.column("text")):
                h1, h2, text, place, parts = cut.spans()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1, h2, ids[k + text], digests[k + text], place.astype(np.int32), parts.astype(np.int32))], names=[x.split()[0] for x in SPAN_SCHEMA.split(", ")])

    return docs.select("id", "digest", "text").mapInArrow(run, SPAN_SCHEMA)


def _maybe(df: DataFrame, h: Column, keys: DataFrame, key: Column, n: int) -> DataFrame:
    words = common.filter_words(n)
    flagged = common.maybe_member(df, h, common.membership_filter(keys.select(key.alias("h")), words), words, "_quern_maybe")
    return flagged.where("_quern_maybe").drop("_quern_maybe")


def repeats(docs: DataFrame) -> DataFrame:
    """(id, digest, place, parts, first_id): every occurrence of a repeated span but its first, of keyed docs.

    Half a hash tells which spans may be repeated; only those meet with their whole hash. Occurrences fold together before
    a shuffle, and the spans behind which many occurrences stand are joined by broadcast, so a passage that very many
    documents share does no harm."""
    found = common.stored(all_spans(docs), "spans")
    halves = common.stored(found.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1"), "halves")
    maybe = common.stored(_maybe(found, F.xxhash64("h1"), halves, F.xxhash64("h1"), halves.count()), "maybe")
    firsts = maybe.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = common.stored(firsts, "several")
    total = several.agg(F.sum("n")).first()[0] or 0
    least = max(2, -(-total // HEAVY_SHARE))
    heavy = F.broadcast(several.where(F.col("n") >= least).drop("n"))
    light = several.where(F.col("n") < least).drop("n")
    hits = common.stored(maybe.join(heavy, ["h1", "h2"]).unionByName(maybe.join(light, ["h1", "h2"])), "hits")
    # within the first document's rows only the first text and place is the first occurrence
    own = hits.where("id = first_id")
    again = own.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    own = common.stored(own.join(again, ["h1", "h2"]), "own")
    first = own.groupBy("h1", "h2").agg(F.min(F.struct("digest", "place")).alias("first"))
    later = own.join(first, ["h1", "h2"]).where(F.struct("digest", "place") != F.col("first"))
    columns = ["id", "digest", "place", "parts", "first_id"]
    return hits.where("id != first_id").select(*columns).unionByName(later.select(*columns))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """The documents that lose parts: doc_id, sentences (parts), removed, first_doc_ids (ids where the removed spans stand
    first, ascending) and the text that is left. Documents that are not returned stay as they are.

    docs needs doc_id and text. Null, empty and blank texts have no spans. Rows without an id are compared and come last in
    order; as first occurrences they have no id to name. Rows that share an id but not their text are documents of their
    own; rows that share both are one, so a repeated row loses nothing to itself and each of its rows is returned. Extra
    columns are ignored; an empty table gives an empty result. Texts are whole, and no text is shuffled but of documents
    that may have a repeated span."""
    common.small_text_batches(docs.sparkSession)
    docs = keyed(docs)
    found = common.stored(repeats(docs), "repeats")
    # a document's removals are bounded by its own parts
    named = F.sort_array(F.collect_set(F.when(F.col("first_id") != NO_ID, F.col("first_id"))))
    by_doc = common.stored(found.groupBy("id", "digest").agg(F.collect_set(F.struct("place", "parts")).alias("covered"), named.alias("first_doc_ids")), "removals")
    key = F.xxhash64("id", "digest")
    maybe = _maybe(docs, key, by_doc, key, by_doc.count())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = batch.column("covered")
            rows = np.repeat(np.arange(batch.num_rows), covered.value_lengths().to_numpy())
            place, size = (covered.flatten().field(c).to_numpy().astype(np.int64) for c in ("place", "parts"))
            for k, raw, parts in cuts(batch.column("text")):
                m = len(parts.offsets) - 1
                mine = (rows >= k) & (rows < k + m)
                begin = parts.first_part[rows[mine] - k] + place[mine]
                steps = np.bincount(begin, minlength=len(parts.final) + 1) - np.bincount(begin + size[mine], minlength=len(parts.final) + 1)
                gone = np.cumsum(steps)[:-1] > 0
                left, totals, removed = [], np.diff(parts.first_part), []
                for t in range(m):
                    kept, at, n = [], int(parts.offsets[t]), 0
                    for p in np.flatnonzero(gone[parts.first_part[t] : parts.first_part[t + 1]]) + parts.first_part[t]:
                        kept.append(raw[at : parts.starts[parts.first[p]]])
                        at = int(parts.ends[parts.final[p]])
                        n += 1
                    kept.append(raw[at : parts.offsets[t + 1]])
                    left.append(b"".join(kept).decode("utf-8", "surrogatepass"))
                    removed.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(k, m), pa.array(totals, pa.int32()), pa.array(removed, pa.int32()), batch.column("first_doc_ids").slice(k, m).cast(pa.list_(pa.int64())), pa.array(left, pa.string())],
                    names=[x.split()[0] for x in REMOVED_SCHEMA.split(", ")],
                )

    return maybe.join(by_doc, ["id", "digest"]).select("doc_id", "text", "covered", "first_doc_ids").mapInArrow(cut, REMOVED_SCHEMA)
