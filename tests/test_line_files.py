"""Files read back by lines, on odd rows: empty texts, line ends at the end, ids that repeat, are null or negative."""

from __future__ import annotations

import oracle
import pytest

from quern.plans.catalogue import ORACLES, QUERIES

TEXTS = [None, "", "\n", "\n\n", "a\n", "a\n\n", "a\n\r", "a\r\n", "a\n\u2028", "a\n\x85", "a\u2028b", "\r", "é\x00\n x \n"]
TABLES = {
    "texts": list(enumerate(TEXTS)),
    "ids": [(1, "a"), (1, "b\nc"), (1, "b\nc"), (1, ""), (1, ""), (-5, "d"), (None, "e"), (None, ""), (2**62, "f")],
    "nulls": [(1, None), (None, None)],
    "none": [],
}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_odd_rows_equal_the_sql(spark, tmp_path, name):
    folder = str(tmp_path / "in")
    spark.createDataFrame(TABLES[name], "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    found = oracle.differences(oracle.connect(folder), QUERIES["line_files"](spark, folder), ORACLES["line_files"], str(tmp_path / "out"))
    assert found[0] == found[1] and found[2:] == (0, {})
