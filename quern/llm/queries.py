"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import id_remainder, scratch_path, table

#: Where public tokenizer files are looked up.
BYTE_TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"


EXACT_DEDUP_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain assignment of every part in every round. Sums are floored without a division of negative numbers."""
    apart = "CAST(list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (c.v[i] - b.v[i]) * (c.v[i] - b.v[i]))) AS BIGINT)"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT c.vec_id, c.p, any_value(c.label) AS label, any_value(c.v) AS v, arg_min(b.e, {apart} * {entries} + b.e) AS e, min({apart}) AS apart FROM c JOIN b{k} b ON b.p = c.p GROUP BY c.vec_id, c.p)")
        if k < rounds:
            steps.append(f"s{k} AS (SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM a{k}) GROUP BY p, e, i)")
            steps.append(f"m{k} AS (SELECT p, e, list((s - (((s % n) + n) % n)) // n ORDER BY i) AS v FROM s{k} GROUP BY p, e)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m ON m.p = b.p AND m.e = b.e)")
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS v FROM k CROSS JOIN range({parts}) r(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM c QUALIFY e < {entries}),
{", ".join(steps)},
d AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM b{rounds})),
o AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(apart) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM o CROSS JOIN d
"""


#: Every pair of documents that share a shingle is counted; links are followed to their ends.
MINHASH_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS s FROM w),
u AS MATERIALIZED (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS h FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
r(doc_id, x) AS (SELECT a, a FROM l UNION SELECT l.b, r.x FROM r JOIN l ON l.a = r.doc_id WHERE r.x < l.b),
m AS (SELECT doc_id, min(x) AS x FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(m.x, doc_id) AS component_id, coalesce(m.x, doc_id) = doc_id AS kept FROM s LEFT JOIN m USING (doc_id)
"""


#: crc32 byte by byte, with its table made by eight halvings; near words share what is left of them without one letter.
SPELLINGS_SQL = r"""
WITH RECURSIVE t(i, k, v) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM t WHERE k < 8),
x AS MATERIALIZED (SELECT i, v FROM t WHERE k = 8),
o AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents) WHERE length(w) >= 6 GROUP BY 1, 2),
b AS MATERIALIZED (SELECT row_number() OVER () AS id, w, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS b FROM o),
h(id, i, h) AS (SELECT id, 1, 4294967295 FROM b UNION ALL SELECT h.id, h.i + 1, xor(h.h >> 8, x.v) FROM h JOIN b ON b.id = h.id JOIN x ON x.i = xor(h.h, b.b[h.i]::BIGINT) & 255 WHERE h.i <= len(b.b)),
c AS (SELECT b.w, b.n, xor(h.h, 4294967295) AS h FROM h JOIN b ON b.id = h.id WHERE h.i = len(b.b) + 1),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM c) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, n, length(word) AS l, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON b.d = a.d AND b.i = a.i AND b.word <> a.word
  UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN v b ON b.word = a.d UNION SELECT b.word, b.n, a.word, a.n FROM d a JOIN v b ON b.word = a.d),
q AS (SELECT word, count(*) AS n_near, arg_max(near, near_n) FILTER (rn = 1) AS near, max(near_n) AS near_n FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS rn FROM p) GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN q USING (word)),
r(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM r JOIN f ON f.form = r.word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN r USING (word)
"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import url_filter

    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark))


def taught(documents: DataFrame) -> DataFrame:
    """The labelled rows that language ID may learn from."""
    return documents.where(id_remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import langid

    documents = table(spark, sf_dir, "documents")
    found = langid.predict(documents, langid.fit(taught(documents)))
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import token_store

    path = scratch_path(spark, "tokens")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_path(BYTE_TOKENIZER), end_id=2)
    return token_store.read_store(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import pii

    return pii.find(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import packing

    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), end_id=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import ppm

    return ppm.score(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import vector_codes

    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm import spellings

    return spellings.group_spellings(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_exact_dedup,
        op2_url_filter,
        op3_language_id,
        op4_token_output,
        op5_substring_dedup,
        op6_pii,
        op7_packing,
        op8_lm_scoring,
        op9_simhash,
        op10_decontamination,
        op11_vector_codes,
        op12_minhash,
        op13_spellings,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP_SQL, "op11_vector_codes": vector_codes_sql(), "op12_minhash": MINHASH_SQL, "op13_spellings": SPELLINGS_SQL}
