"""Rows that every text operator must take: nulls, blanks, very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

LONG = "Word soup number %d goes on and on. "
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, digest string, fp long, key string, chunk long, n long, piece int, start long, length long"


def odd_rows() -> list[tuple]:
    texts = [
        (1, "Hello World again, one two three."),
        (2, "hello world again, one two three."),
        (2, "hello world again, one two three."),
        (3, None),
        (4, ""),
        (5, "  \t\n "),
        (None, "No id here."),
        (None, None),
        (6, "".join(LONG % i for i in range(4000))),
        (7, "x" * 60_000),
        (8, "7" * 3_000),
        (9, "ÀÉÎ 日本語 \U0001f600 naïve\x00text"),
        (10, "Two."),
        (10, "Other text, same id."),
    ]
    return [(i, t, "en" if i != 9 else None, "s", None, 1, "d", 2, "k", 3, 4, 5, 6, 7) for i, t in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
