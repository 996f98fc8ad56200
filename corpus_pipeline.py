"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents.

language ID -> exact dedup -> near-duplicate removal -> benchmark decontamination -> packing. The first four filter and
return the columns of documents; the last returns the packed pieces. Nulls, empty tables, ties and repeated rows are
treated as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.llm import common, decontaminate, exact_dedup, langid, near_copies, packing
from quern.llm.queries import WORD_TOKENIZER, taught, tokenizer_path

#: Packing appends this id to each document.
END_ID = 1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a sufficient margin (op3)."""
    return langid.without_rejected(docs, langid.fit(taught(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts, that of the largest doc_id (op1)."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near copies: five-word Jaccard similarity of 0.8 or more.

    Pairs come from the trie self-join of fingerprints (op9), wider here, and from MinHash bands beyond its budget."""
    return near_copies.without_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item (op10)."""
    return decontaminate.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts and packs what is left into sequences (op7)."""
    return packing.pack_documents(docs, tokenizer_path(WORD_TOKENIZER), END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminate", leaks),
    ("pack", pack),
]
#: SQL cannot express the stages (compression, near duplicates, edit distance, packing); tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each to the stored result of the one before."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.stored(docs, f"stage-{name}")
    return docs
