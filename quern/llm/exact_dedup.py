"""Exact deduplication as a log-structured merge index, in DataFrame operations only.

* Flush: each task's memtable becomes a run, a file of (digest, identifier) sorted by digest. Runs hold ids and digests;
  no text is shuffled for them.
* Compaction merges the fresh runs into a level and keeps the smallest identifier of each digest. A task folds its own runs
  first, which come sorted, and sends one entry for each of its digests to the one that digest's hash names; so a digest that a
  third of the rows have costs one entry a task. The merged entries are then dealt by digest ranges and sorted: a second
  exchange, of one entry for each digest. A level is stored in that order with a membership filter of its digests, which the
  look-ups of later flushes read (a single flush has none). Once there are more than FANOUT levels, they are merged into
  one in the same way. The contract wants the largest doc_id to stay, so identifiers count downwards from it (the complement of
  doc_id, then of the flush and the row's number).
* Look-up: a later flush passes the filters of the levels before it; only digests that may be there are joined with them.
* Byte verification: rows whose digest is a hit, found by a broadcast membership filter of bounded size, are grouped by
  digest and whole text. Copies fold together before the shuffle, so a hot text costs one row for each task. Digests
  that cover more than one text are resolved by text.
* Digests that hold at least a thousandth of the rows (a thousand at most) are broadcast to the rows, the rest joined.

Defined cases: null text counts as empty, and empty texts are equal to each other. A null doc_id stays only where all ids of
the group are null. Of rows that share the staying doc_id and text, one is kept. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import common

#: A digest with at least one in so many rows is looked up by broadcast: so many digests at most.
HEAVY_SHARE = 1000
DIGEST_BYTES = 32
#: Levels beyond which all are merged into one.
FANOUT = 4


def normalised(text: Column) -> Column:
    return common.ascii_lower(F.coalesce(text, F.lit("")))


def identifier() -> Column:
    """Ascending in the order in which rows are preferred."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.bitwise_not("doc_id").alias("not_id"), F.col("row").alias("row"))


def flush(docs: DataFrame, digest_bytes: int = DIGEST_BYTES, number: int = 0) -> DataFrame:
    """The stored runs: (digest, sha, doc_id, row), each file sorted by digest, the first digest_bytes of sha. number tells
    the flushes of an index apart."""
    sha = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    row = F.monotonically_increasing_id() + F.lit(number << 56)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), sha.alias("sha"))
    rows = rows.withColumn("digest", F.substring("sha", 1, digest_bytes))
    return common.stored(rows.sortWithinPartitions("digest"), "runs")


def entries(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs as entries of a level: (keys, best, group_size), one for each row."""
    return runs.select(*keys, identifier().alias("best"), F.lit(1).cast("long").alias("group_size"))


def merge(found: DataFrame, *keys: str) -> DataFrame:
    """Compaction: one entry for each key, with the smallest identifier and the sum of the sizes."""
    return found.groupBy(*keys).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))


def named(level: DataFrame, *keys: str) -> DataFrame:
    """Entries as (keys, keep_id, keep_row, group_size)."""
    return level.select(*keys, F.bitwise_not("best.not_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


class Index:
    """The index: fresh runs and levels. Its state is a list of stored tables."""

    def __init__(self, digest_bytes: int = DIGEST_BYTES):
        self.digest_bytes = digest_bytes
        self.runs: list[DataFrame] = []
        self.fresh: list[DataFrame] = []
        self.levels: list[tuple[DataFrame, DataFrame, int]] = []

    def flush(self, docs: DataFrame) -> DataFrame:
        runs = flush(docs, self.digest_bytes, len(self.runs))
        self.runs.append(runs)
        self.fresh.append(runs)
        return runs

    def _level(self, found: list[DataFrame]) -> tuple[DataFrame, DataFrame, int]:
        all_entries = found[0]
        for more in found[1:]:
            all_entries = all_entries.unionByName(more)
        parts = max(1, int(all_entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        ordered = merge(all_entries, "digest").repartitionByRange(parts, "digest").sortWithinPartitions("digest")
        level = common.stored(ordered, "level")
        words = common.filter_words(level.count())
        return level, common.stored(common.membership_filter(level.select(F.xxhash64("digest").alias("h")), words), "level-filter"), words

    def compact(self) -> None:
        """Fresh runs become a level; more than FANOUT levels become one."""
        if self.fresh:
            self.levels.append(self._level([entries(r, "digest") for r in self.fresh]))
            self.fresh = []
        if len(self.levels) > FANOUT:
            self.levels = [self._level([level for level, _, _ in self.levels])]

    def merged(self) -> DataFrame:
        """The entries of all levels, one for each digest. A digest's entries in other levels are looked for among those
        that pass the other level's filter; the rest of a level is final."""
        if len(self.levels) == 1:
            return self.levels[0][0]
        meet, final = None, None
        for k, (level, _, _) in enumerate(self.levels):
            flagged = level
            for j, (_, filt, words) in enumerate(self.levels):
                if j != k:
                    flagged = common.maybe_member(flagged, F.xxhash64("digest"), filt, words, f"_in_{j}")
            somewhere = F.greatest(*[F.col(f"_in_{j}").cast("int") for j in range(len(self.levels)) if j != k], F.lit(0)) == 1
            shared, alone = flagged.where(somewhere).select(*level.columns), flagged.where(~somewhere).select(*level.columns)
            meet, final = (shared, alone) if meet is None else (meet.unionByName(shared), final.unionByName(alone))
        return merge(meet, "digest").unionByName(final)

    def resolve(self, docs: DataFrame) -> DataFrame:
        """The result for all rows flushed; docs holds their texts, by which hits are verified."""
        runs = self.runs[0]
        for more in self.runs[1:]:
            runs = runs.unionByName(more)
        total = runs.count()
        merged = common.stored(named(self.merged().where("group_size > 1"), "digest"), "merged")
        n_hits = merged.count()
        if n_hits:
            texts = suspected_texts(docs, merged, n_hits, self.digest_bytes).groupBy("digest", "text").count()
            collided = common.stored(texts.groupBy("digest").count().where("count > 1").select("digest"), "collided")
            if not collided.isEmpty():
                if self.digest_bytes >= DIGEST_BYTES:
                    raise RuntimeError("unequal texts share a whole SHA-256 digest; nothing is merged")
                # equal digests of unequal texts: the texts themselves tell the groups apart, by the full hash that the runs carry
                runs = runs.join(collided.withColumn("_split", F.lit(True)), "digest", "left").withColumn("digest", F.when(F.col("_split"), F.col("sha")).otherwise(F.col("digest"))).drop("_split")
                merged = named(merge(entries(runs, "digest"), "digest"), "digest")
        found = look_up(runs, merged, total, ["digest"])
        kept = F.col("row") == F.col("keep_row")
        return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def suspected_texts(docs: DataFrame, hits: DataFrame, n_hits: int, digest_bytes: int) -> DataFrame:
    """(doc_id, text, digest) of rows whose digest may be among hits, the text normalised."""
    words = common.filter_words(n_hits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    rows = rows.withColumn("digest", F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, digest_bytes))
    found = common.membership_filter(hits.select(F.xxhash64("digest").alias("h")), words)
    return common.maybe_member(rows, F.xxhash64("digest"), found, words, "_quern_maybe").where("_quern_maybe").drop("_quern_maybe")


def look_up(runs: DataFrame, merged: DataFrame, total: int, keys: list[str]) -> DataFrame:
    """runs with keep_id, keep_row and group_size; rows without a match are groups of their own."""
    least = max(2, -(-total // HEAVY_SHARE))
    heavy = F.broadcast(merged.where(F.col("group_size") >= least))
    light = merged.where((F.col("group_size") < least) & (F.col("group_size") > 1))
    hot = runs.join(heavy, keys)
    cold = runs.join(heavy.select(*keys), keys, "left_anti").join(light, keys, "left")
    cold = cold.withColumns({"keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")), "keep_row": F.coalesce("keep_row", "row"), "group_size": F.coalesce("group_size", F.lit(1))})
    return hot.unionByName(cold)


def exact_dedup(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    index = Index(digest_bytes)
    index.flush(docs)
    index.compact()
    return index.resolve(docs)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all columns. The texts of clean rows are not shuffled."""
    judged = common.stored(exact_dedup(docs), "judged")
    gone = judged.where("not kept")
    n_gone = gone.count()
    if not n_gone:
        return docs
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_quern_key")
    keyed = docs.withColumns({"_quern_key": key, "_quern_sha": F.sha2(normalised(F.col("text")).cast("binary"), 256)})
    gone = gone.select(key, F.col("text_sha256").alias("_quern_sha"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("again"))
    stays = common.without_rows(keyed, gone.where("not again"), n_gone, ("_quern_key", "_quern_sha"))
    again = gone.where("again").select("_quern_key", "_quern_sha").distinct()
    if not again.isEmpty():
        # rows that repeat the staying row itself: one of each is left
        twice, once = stays.join(again, ["_quern_key", "_quern_sha"], "left_semi"), stays.join(again, ["_quern_key", "_quern_sha"], "left_anti")
        first = twice.groupBy("_quern_key", "_quern_sha").agg(F.first(F.struct(*docs.columns)).alias("_r")).select("_r.*")
        return once.select(*docs.columns).unionByName(first)
    return stays.select(*docs.columns)
