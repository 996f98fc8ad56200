"""Language identification by compression.

A language's model is a raw-content zstandard dictionary: whole texts of a bounded sample of its labelled documents.
A text is cut into pieces of PIECE_BYTES, every piece is compressed with each language's dictionary, and the language
whose frames are smallest in all is chosen. Pieces keep a long text from becoming its own dictionary, which would
blur the margin. The margin, (second best - best) / second best, is the score; under MIN_MARGIN a text is rejected.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm import common

#: Labelled documents of each language that may be drawn, by a hash of their id, and what a dictionary holds of them: the
#: sample's bounds. Whole texts are drawn in a random order, those that fit.
SAMPLE_DOCS = 400
DICTIONARY_BYTES = 128 << 10
PIECE_BYTES = 2 << 10
LEVEL = 7
MIN_MARGIN = 0.01
UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


#: What is not a letter: it says nothing of the language and would drown the letters of junk lines.
NOT_LETTERS = re.compile(r"[\W\d_]+")


def prepared(text: str) -> bytes:
    """Lower-case letters with single spaces between their runs, as UTF-8."""
    return NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def fit(labelled: DataFrame) -> dict[str, bytes]:
    """language -> dictionary, the commonest first, from labelled (doc_id, text, lang); rows without a language or a text teach nothing.

    The sample is drawn on ids alone, from a hash range that suits each language's frequency, so a language that holds
    most rows costs no more than others; only the sampled texts are fetched."""
    rows = labelled.where("lang is not null and text is not null and doc_id is not null")
    rows_of = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows_of:
        return {}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # a few times the sample's share of each language, so that even the commonest meets in one task as some thousand ids
    share = F.create_map(*[x for lang, n in rows_of.items() for x in (F.lit(lang), F.lit(min(1 << 40, (1 << 40) * 8 * SAMPLE_DOCS // n)))])
    ids = rows.select("doc_id", "lang").where(place < share[F.col("lang")]).distinct()
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_DOCS)
    texts = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    sizes = texts.select("doc_id", "lang", "rank", F.octet_length("text").alias("size")).groupBy("lang", "rank").agg(F.sum("size").alias("size")).collect()
    # whole texts in the order of the draw; one that does not fit any more is skipped
    full: dict[str, int] = {}
    drawn: dict[str, list[int]] = {}
    for r in sorted(sizes, key=lambda r: r["rank"]):
        if full.get(r.lang, 0) + r.size <= DICTIONARY_BYTES:
            full[r.lang] = full.get(r.lang, 0) + r.size
            drawn.setdefault(r.lang, []).append(r["rank"])
    for r in sorted(sizes, key=lambda r: (r["size"], r["rank"])):
        drawn.setdefault(r.lang, [r["rank"]])  # none fits: the shortest one, whole
    wanted = labelled.sparkSession.createDataFrame([(lang, rank) for lang, places in drawn.items() for rank in places], "lang string, rank int")
    by: dict[str, bytes] = {}
    for r in texts.join(F.broadcast(wanted), ["lang", "rank"]).orderBy("rank", "text").collect():
        by[r.lang] = by.get(r.lang, b"") + prepared(r.text) + b" "
    return {lang: by[lang] for lang in sorted(by, key=lambda x: (-rows_of[x], x))}


class Compressors:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.languages = list(dictionaries)
        self.by_language = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.by_language.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        """Bytes of all the text's frames for each language."""
        raw = prepared(text)
        pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        return [sum(len(compress(p)) for p in pieces) for compress in self.by_language]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected); ties go to the commoner language and are rejected."""
        if not text or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = [s for i, s in enumerate(sizes) if i != best]
        score = (min(rest) - sizes[best]) / min(rest) if rest else 1.0
        return self.languages[best], score, score < MIN_MARGIN


def compressors(number: str, sent: Broadcast) -> Compressors:
    """The worker's compressors of one call; they take the place of another stage's model."""
    return common.held(number, lambda: Compressors(sent.value))


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of docs (doc_id, text); only the text is looked at.

    Null, empty and letterless texts, and all texts where nothing was learned, are `und` with score 0 and rejected.
    Repeated rows repeat, extra columns are ignored, an empty table gives an empty result."""
    common.small_text_batches(docs.sparkSession)
    sent, number = docs.sparkSession.sparkContext.broadcast(dictionaries), uuid.uuid4().hex

    @common.gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = compressors(number, sent).judge
        for batch in batches:
            found = [judge(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def without_rejected(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """docs whose language is told with a sufficient margin; all columns, in one pass and without a shuffle. Rows are judged
    by their text alone: those of null, empty or letterless texts go, whatever their ids; equal rows share a fate."""
    common.small_text_batches(docs.sparkSession)
    sent, number = docs.sparkSession.sparkContext.broadcast(dictionaries), uuid.uuid4().hex

    def judge() -> Callable[[list[str | None]], list[bool]]:
        told = compressors(number, sent).judge
        return lambda texts: [not told(t)[2] for t in texts]

    return docs.where(common.text_flags(judge, F.col("text")))
