"""Each operator against brute force on small tables, and on odd rows and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import empty, odd, odd_rows
from oracle import connect, differences
from pyspark.sql import functions as F

from quern.llm import common, decontaminate, exact_dedup, langid, packing, pii, ppm, queries, simhash, substring_dedup, token_store, url_filter, wordruns

A_TO_Z = re.compile("[A-Z]")


def low(text):
    return A_TO_Z.sub(lambda m: m[0].lower(), text or "")


def documents(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


def rows(df):
    return [r.asDict() for r in df.collect()]


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path(name))
    tk.encode_special_tokens = True
    return lambda text: tk.encode(text, add_special_tokens=False).ids


# 1: exact dedup


def test_exact_dedup_equals_sql(spark, sf_dir, tmp_path):
    con = connect(sf_dir)
    mine, theirs, n, kinds = differences(con, queries.op1_exact_dedup(spark, sf_dir), queries.EXACT_DEDUP_SQL, str(tmp_path / "o"))
    assert (mine, n, kinds) == (theirs, 0, {})


def plain_exact(table):
    groups = defaultdict(list)
    for i, text in table:
        groups[low(text)].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_exact_dedup_on_odd_rows_and_colliding_digests(spark, digest_bytes):
    out = rows(exact_dedup.exact_dedup(odd(spark), digest_bytes))
    expected = plain_exact([(r[0], r[1]) for r in odd_rows()])
    sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in expected.items()}
    assert len(out) == len(odd_rows())
    assert all((r["keep_id"], r["group_size"]) == sha[r["text_sha256"]] for r in out)
    assert Counter(r["text_sha256"] for r in out if r["kept"]) == Counter(list(sha))
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_without_copies_keeps_one_row_of_each_text(spark):
    out = exact_dedup.without_copies(odd(spark))
    assert out.columns == odd(spark).columns
    kept = Counter((r.doc_id, low(r.text)) for r in out.collect())
    assert kept == Counter((i, t) for t, (i, _) in plain_exact([(r[0], r[1]) for r in odd_rows()]).items())
    assert exact_dedup.without_copies(empty(spark)).count() == 0


def test_exact_dedup_is_native(spark, sf_dir):
    text = queries.op1_exact_dedup(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|InMemoryTableScan", text)


# 2: url filters


def plain_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match("[^/?#]*", rest)[0]
    return low(host), re.match("[^?#]*", rest[len(host) :])[0]


def test_url_filter_equals_brute_force(spark, sf_dir):
    odd_urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.COM/en/7#x", "a://b://c/d?e", "x://example.net/de/8/", "x://deexample.net/de/8", "http://com/en/", "http://h?q=/en/", "http://cheap-pills.example.org/"]
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url").unionByName(spark.createDataFrame(list(enumerate(odd_urls, 10_000)), "page_id long, url string"))
    labelled = url_filter.labelled_urls(spark)
    weights, bias = url_filter.train(sorted((*plain_url(r.url), r.blocked) for r in labelled.collect()))
    urls = {r.page_id: r.url for r in pages.collect()}
    out = rows(url_filter.judge(pages, labelled))
    assert len(out) == len(urls)
    for r in out:
        host, path = plain_url(urls[r["page_id"]])
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        learned = "block" if url_filter.probability(host, path, weights.astype(np.float32), bias) > 0.5 else "allow"
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == ((max(fits)[1], max(fits)[2]) if fits else (None, learned))
    assert url_filter.judge(pages.limit(0), labelled).count() == 0
    assert {r.verdict for r in url_filter.judge(pages.where("page_id >= 10000"), labelled.limit(0)).where("rule is null").collect()} == {"allow"}


def test_url_model_on_words_it_was_not_taught(spark):
    model = url_filter.train(sorted((*plain_url(r.url), r.blocked) for r in url_filter.labelled_urls(spark).collect()))
    assert url_filter.probability("cheap-pills-24.example.com", "/x", *model) > 0.5
    assert url_filter.probability("ththing.example.com", "/en/99", *model) < 0.5


# 3: language


def test_language_on_held_out_documents(spark):
    found = queries.op3_language_id(spark, "/root/testdata/sf0.01").join(documents(spark, "/root/testdata/sf0.01").select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    out = rows(found.where("held_out and n >= 40"))
    assert len(out) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98
    assert sum(r["rejected"] for r in out) / len(out) < 0.03
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_takes_no_hint_and_odd_rows(spark, sf_dir):
    model = langid.fit(queries.taught(documents(spark, sf_dir)))
    assert set(model) == {"en", "de", "fr", "es"} and next(iter(model)) == "en"
    out = {(r["doc_id"], r["score"]): r for r in rows(langid.predict(odd(spark), model))}
    by_id = defaultdict(list)
    for (i, _), r in out.items():
        by_id[i].append(r["lang_pred"])
    assert by_id[3] == by_id[4] == by_id[5] == by_id[8] == ["und"]
    assert langid.predict(empty(spark), model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd(spark), langid.fit(empty(spark))).collect()} == {"und"}
    kept = langid.without_rejected(odd(spark), model)
    assert kept.columns == odd(spark).columns and kept.where("doc_id in (3, 4, 5, 8)").count() == 0


# 4: token store


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((0, 0), (1, 0), (1, 10**6), (5, 3), (1000, 10**7), (300, 10), (70, 2**31)):
        values = np.sort(rng.integers(0, top + 1, n))
        code = token_store.EliasFano(*token_store.EliasFano.encode(values), n)
        assert code.all().tolist() == values.tolist()
        assert [code.select(i) for i in range(n)] == values.tolist()
    low_, bits, high, select = token_store.EliasFano.encode(np.sort(rng.integers(0, 10**6, 1000)))
    assert len(low_) + len(high) + len(select) < 1000 * (2 + math.log2(1000) + 1) / 8 + 100


def test_token_store_round_trip(spark, sf_dir, tmp_path):
    encode = tokenizer(queries.BYTE_TOKENIZER)
    shuffled = documents(spark, sf_dir).repartition(5, "text")
    assert token_store._ascending_partitions(documents(spark, sf_dir).select("doc_id", "text")) == {0: 0}
    assert token_store._ascending_partitions(shuffled.select("doc_id", "text")) is None
    for k, df in enumerate((documents(spark, sf_dir), shuffled, odd(spark))):
        path = f"file://{tmp_path}/{k}"
        token_store.write_store(df, path, queries.tokenizer_path(queries.BYTE_TOKENIZER), 2)
        table = sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
        start, expected = 0, []
        for i, text in table:
            ids = [*encode(text or ""), 2]
            expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        found = token_store.read_store(spark, path)
        assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.orderBy("start").collect()] == expected
        ids = token_store.read_store(spark, path, with_ids=True).orderBy("start").collect()
        assert [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in ids] == [e[3] for e in expected]
    token_store.write_store(empty(spark), f"file://{tmp_path}/none", queries.tokenizer_path(queries.BYTE_TOKENIZER), 2)
    assert token_store.read_store(spark, f"file://{tmp_path}/none").count() == 0


ODD_TEXTS = ["", " ", "a  b", " a b ", "a\n b", "x\t y", "it's 'll don 't", "<|endoftext|> hi <|startoftext|>", "É é ́x", "ΑΣ ΑΣ.Α", "a\x1cb c", "日本語 テスト", "a b", "1 2  30 0 ..", "0", "00 0", "İ ı ß ẞ", "a,. b., c.", "ÀÉ ÇA. ßÑ", "A.\r\nB", ". , .,"]


@pytest.mark.parametrize(("name", "drops"), [(queries.BYTE_TOKENIZER, False), (queries.WORD_TOKENIZER, True)])
def test_memoised_encoding_is_exact(spark, sf_dir, name, drops):
    from quern.llm.tokens import Encoder

    encode, mine = tokenizer(name), Encoder(queries.tokenizer_path(name), drops)
    texts = ODD_TEXTS + [r.text for r in documents(spark, sf_dir).collect()]
    for part in (ODD_TEXTS, texts, ODD_TEXTS[::-1]):
        assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(part)] == [encode(t) for t in part]


# 5: substring dedup


M64 = (1 << 64) - 1


def plain_hash(word):
    """The first lane's polynomial, byte by byte."""
    out, power = 0, 1
    for c in word.encode().lower():
        out = (out + int(wordruns.BYTE_VALUES[0][c]) * power) & M64
        power = power * wordruns.BYTE_BASES[0] & M64
    out = (out ^ out >> 32) * 0x9E3779B97F4A7C15 & M64
    return out ^ out >> 29


def plain_parts(text):
    """[(start, end, words)] by regular expressions: sentences, then runs of a long one."""
    out = []
    for line in re.finditer(r"[^\n]+", text):
        sentence = []
        words = list(re.finditer(r"[^ \t\n\v\f\r]+", line[0]))
        for k, m in enumerate(words):
            sentence.append((line.start() + m.start(), line.start() + m.end(), low(m[0])))
            if m[0][-1] in ".!?" or k + 1 == len(words):
                h = [plain_hash(w) for *_, w in sentence]
                runs = [range(i, i + 8) for i in range(len(h) - 7)] if len(h) > 8 else []
                ends = sorted({i for r in runs for i in r if h[i] == min(h[j] for j in r)} | {len(h) - 1})
                for a, b in zip([-1, *ends], ends, strict=False):
                    part = sentence[a + 1 : b + 1]
                    out.append((part[0][0], part[-1][1], tuple(w for *_, w in part)))
                sentence = []
    return out


def plain_spans(text):
    """[(words, place, parts)] of the spans that count."""
    parts, out, first_end = plain_parts(text), [], {}
    for i in range(len(parts)):
        for j in range(i + 2, len(parts) + 1):
            words = sum((p[2] for p in parts[i:j]), ())
            if len(words) >= 20:
                if i >= first_end.setdefault(words, j) or first_end[words] == j:
                    out.append((words, i, j - i))
                break
    return out


def plain_substring_dedup(table):
    """(id, text) -> (text left, parts, removed, ids of firsts) of the documents that lose parts; ids may be missing."""
    first, gone = {}, defaultdict(set)
    for i, text in sorted(set(table), key=lambda r: (r[0] is None, r[0] or 0)):
        for words, place, size in plain_spans(text):
            if words in first:
                gone[i, text].add((place, size, first[words]))
            else:
                first[words] = i
    out = {}
    for (i, text), found in gone.items():
        parts = plain_parts(text)
        dropped = {k for place, size, _ in found for k in range(place, place + size)}
        left, at = "", 0
        for k, (a, b, _) in enumerate(parts):
            if k in dropped:
                left, at = left + text[at:a], b
        out[i, text] = (left + text[at:], len(parts), len(dropped), sorted({f for *_, f in found if f is not None}))
    return out


def test_substring_dedup_equals_brute_force(spark, sf_dir):
    table = [(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()]
    table = [r for r in table if len(r[1]) < 20_000]
    expected = plain_substring_dedup(table)
    out = rows(substring_dedup.substring_dedup(spark.createDataFrame(table, "doc_id long, text string")))
    assert len(out) == len(expected) > 10
    for r in out:
        assert (r["text"], r["sentences"], r["removed"], r["first_doc_ids"]) == expected[r["doc_id"], dict(table)[r["doc_id"]]]


def test_substring_dedup_keeps_rows_of_one_id_apart(spark):
    p = " ".join(f"passage{k}" for k in range(40)) + "."
    q = " ".join(f"quite{k}" for k in range(40)) + "."
    table = [(1, p), (7, p), (7, q), (7, p), (None, q), (None, q), (None, "x " + p)]
    out = rows(substring_dedup.substring_dedup(spark.createDataFrame(table, "doc_id long, text string")))
    expected = plain_substring_dedup(table)
    assert set(expected) == {(7, p), (None, q), (None, "x " + p)}
    found = Counter((r["doc_id"], r["text"], r["removed"], tuple(r["first_doc_ids"])) for r in out)
    times = Counter(table)
    assert found == {(i, left, removed, tuple(firsts)): times[i, text] for (i, text), (left, _, removed, firsts) in expected.items()}
    assert not any("passage20" in r["text"] for r in out) and all("quite20" not in r["text"] for r in out if r["first_doc_ids"] == [7])


def test_substring_dedup_finds_a_passage_inside_other_text(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(5, 12))) + "."
    for passage in (" ".join(sentence() for _ in range(8)), " ".join(word() for _ in range(70))):
        table = [(i, f"{sentence()} {' '.join(word() for _ in range(4))} {passage} {' '.join(word() for _ in range(3))} {sentence()}") for i in range(5)] + [(9, " ".join(sentence() for _ in range(9)))]
        out = {r["doc_id"]: r for r in rows(substring_dedup.substring_dedup(spark.createDataFrame(table, "doc_id long, text string")))}
        assert set(out) == {1, 2, 3, 4}
        assert all(r["first_doc_ids"][0] == 0 for r in out.values())  # spans at the edges may stand in a later one first
        middle = " ".join(passage.split()[24:36])
        assert all(middle not in r["text"] for r in out.values())


def test_substring_dedup_on_odd_rows(spark):
    out = rows(substring_dedup.substring_dedup(odd(spark)))
    assert {r["doc_id"] for r in out} <= {1, 2, 6, 10}
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


# 6: personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits(m[0])[::-1])) % 10 == 0]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns(spark, sf_dir):
    rng = random.Random(5)
    made = ["".join(rng.choice("a@.1+- 9()2%_\n") for _ in range(rng.randint(0, 120))) for _ in range(3000)]
    made += ["1.2.3.4.5.6.7.8", "a@b.c@d.e", "a@b.c_d@e.f", "4111 1111-1111 1111", "4111111111111112", "+1 (234) 567-8901", "256.1.1.1 0255.1.1.001", "é@a.b x@é.c"]
    for text in made + [r.text for r in documents(spark, sf_dir).collect()]:
        assert pii.base_spans(text) == plain_pii(text), text


def test_pii_rows(spark, sf_dir):
    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    for r in rows(pii.find(documents(spark, sf_dir))):
        base = plain_pii(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (pii.KINDS.index(s[0]), s[1])))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
    assert len(rows(pii.find(odd(spark), with_text=True))) == len(odd_rows())
    assert pii.find(empty(spark)).count() == 0


def test_pii_model_on_unseen_examples():
    trees, cut = pii.model()
    table = pii.examples(99, 3000)
    hit = [trees.predict(np.array([pii.features(t, s)]))[0] >= cut[s[0]] for t, s, _ in table[:600]]
    label = [y for *_, y in table[:600]]
    assert sum(h and y for h, y in zip(hit, label, strict=True)) / sum(hit) > 0.9
    assert sum(h and y for h, y in zip(hit, label, strict=True)) / sum(label) > 0.7
    text = "write to jane.doe (at) mail (dot) org please"
    assert pii.redacted(text, pii.added_spans(text, [], trees, cut)) == "write to [email] please"


# 7: packing


def test_packing_holds_every_token_once(spark, sf_dir):
    encode = tokenizer(queries.WORD_TOKENIZER)
    for df in (documents(spark, sf_dir), odd(spark)):
        packed = packing.pack_documents(df, queries.tokenizer_path(queries.WORD_TOKENIZER), 1, with_ids=True)
        out = rows(packed)
        expected = Counter()
        total = 0
        for r in df.collect():
            ids = [*encode(r.text or ""), 1]
            total += len(ids)
            for k, a in enumerate(range(0, len(ids), 4096)):
                expected[r.doc_id, k, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes())] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
        bins = defaultdict(list)
        for r in out:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(bins) <= -(-total // 4096) + 1
        assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == total
    assert packing.pack_documents(empty(spark), queries.tokenizer_path(queries.WORD_TOKENIZER), 1).count() == 0


def test_fullest_is_the_best_subset():
    rng = random.Random(3)
    for _ in range(150):
        items = [rng.randint(1, 30) for _ in range(rng.randint(0, 8))]
        room = rng.randint(0, 80)
        best = max(s for s in (sum(x for i, x in enumerate(items) if m >> i & 1) for m in range(1 << len(items))) if s <= room)
        chosen = packing.fullest(sorted(Counter(items).items(), reverse=True), room)
        assert sum(n * k for n, k in chosen) == best
        assert all(Counter(items)[n] >= k for n, k in chosen)


def test_plan_uses_up_any_counts():
    rng = random.Random(4)
    for _ in range(20):
        counts = {rng.randint(1, 4096): rng.randint(1, 10**6) for _ in range(rng.randint(1, 60))}
        left = Counter()
        for bins, pattern in packing.plan(counts):
            assert sum(n * k for n, k in pattern) <= 4096
            for n, k in pattern:
                left[n] += bins * k
        assert left == Counter(counts)


# 8: language model


def plain_trie(training, order=ppm.ORDER):
    contexts = defaultdict(Counter)
    for t in training:
        b = b"\0" * order + t + b"\0"
        for i in range(order, len(b)):
            for k in range(order + 1):
                contexts[b[i - k : i]][b[i]] += 1
    return contexts


def plain_ppm(contexts, text, order=ppm.ORDER):
    b, total = b"\0" * order + text + b"\0", 0.0
    for i in range(order, len(b)):
        p, excluded = 1.0, set()
        for k in range(order, -1, -1):
            seen = {s: n for s, n in contexts[b[i - k : i]].items() if s not in excluded} if b[i - k : i] in contexts else {}
            if not seen:
                continue
            whole = sum(seen.values()) + (len(seen) if len(excluded) + len(seen) < 256 else 0)
            if b[i] in seen:
                total += math.log10(p * seen[b[i]] / whole)
                break
            p *= len(seen) / whole
            excluded |= set(seen)
        else:
            total += math.log10(p / (256 - len(excluded)))
    return total


@pytest.mark.parametrize("hot", [ppm.HOT, 500, 0])
def test_scores_equal_brute_force(spark, sf_dir, hot):
    df = documents(spark, sf_dir)
    table = [(r.doc_id, r.text) for r in df.collect()]
    training = [low(t).encode() for i, t in table if common.id_remainder_local(i, 7) != 2]
    counts = Counter(w for t in training for w in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    trie = plain_trie(training)
    out = {r["doc_id"]: r for r in rows(ppm.score(df, hot=hot))}
    assert len(out) == len(table)
    for k, (i, text) in enumerate(table):
        words = [*re.findall(rb"[^\x20\x09-\x0D]+", low(text).encode()), None]
        r = out[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(words), sum(counts[w] > 0 for w in words), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert r["score"] == pytest.approx(plain_ppm(trie, low(text).encode()), rel=1e-9)


def test_scores_on_odd_rows(spark):
    assert len(rows(ppm.score(odd(spark)))) == len(odd_rows())
    untaught = rows(ppm.score(odd(spark), F.lit(False)))
    assert {(r["train_tokens"], r["n_known"]) for r in untaught} == {(0, 0)}
    assert next(r for r in untaught if r["doc_id"] == 4)["score"] == pytest.approx(-math.log10(256))
    assert ppm.score(empty(spark)).count() == 0


def test_code_lengths_are_a_distribution():
    texts = [b"the cat sat on the mat", b"", b"\xff\x00"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    grams, n = ppm.folded(ppm.gram_codes(data, offsets)[0])
    low_ = ppm.folded(grams >> 32 << 8 | grams & 255, n)
    model = ppm.orders(grams, n, low_)
    for context in [*np.unique(grams >> 8), 12345, ord("t") << 32]:
        p = ppm.log10_probabilities(model, (int(context) << 8) + np.arange(256))
        assert (10**p).sum() == pytest.approx(1)


# 9: simhash


def plain_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(table):
    ids, root = [i for i, _ in table], {i: i for i, _ in table}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(table):
        for j, b in table[k + 1 :]:
            if bin(a ^ b).count("1") <= 3 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, sf_dir):
    extra = [(10_000 + k, t) for k, t in enumerate([None, "", " ", "One", "one", "two words", "A b c d e f g h i j k l m n o p q r s t u v w x y z " * 9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 9 + "end"])]
    df = documents(spark, sf_dir).select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in df.collect()]
    expected = plain_components(prints)
    out = rows(simhash.near_duplicates(df))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in out} == {i: (f"{f:016x}", expected[i]) for i, f in prints}
    assert len(rows(simhash.near_duplicates(odd(spark)))) == len(odd_rows())
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("subtrie_rows", [2_000, 3])
def test_links_join_what_chains_join(spark, monkeypatch, subtrie_rows):
    monkeypatch.setattr(simhash, "SUBTRIE_ROWS", subtrie_rows)
    rng = random.Random(6)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
    order = sorted(prints)
    expected = plain_components(list(enumerate(order)))
    edges = simhash.links(spark.createDataFrame([(simhash._signed(p),) for p in order], "fp long"))
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    classes = defaultdict(set)
    for k, p in enumerate(order):
        classes[roots.get(simhash._signed(p), simhash._signed(p))].add(k)
    other = defaultdict(set)
    for k, c in expected.items():
        other[c].add(k)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, other.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    out = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 201: 200}


# 10: decontamination


def plain_edit(pattern, text):
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[-1] + 1))
        before = row
    return min(before)


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        p, t = (bytes(rng.choice(b"abc ") for _ in range(n)) for n in (rng.randint(1, 25), rng.randint(0, 40)))
        assert decontaminate.edit_distance_within(p, t, 100)[0] == plain_edit(p, t)


def test_every_verbatim_leak_is_found_and_nothing_else(spark):
    sf_dir = "/root/testdata/sf0.01"
    out = {(r["doc_id"], r["item_id"]): r for r in rows(queries.op10_decontamination(spark, sf_dir))}
    items = {r.item_id: decontaminate.normalised(r.text) for r in common.table(spark, sf_dir, "benchmark").collect()}
    texts = {r.doc_id: decontaminate.normalised(r.text) for r in documents(spark, sf_dir).collect()}
    verbatim = {(i, k) for i, t in texts.items() for k, x in items.items() if x in t}
    assert verbatim and verbatim <= set(out)
    assert all(r["distance"] <= decontaminate.EDIT_SHARE * r["item_bytes"] for r in out.values())
    for (i, k), r in out.items():
        words = texts[i].split()
        part = b" ".join(words[max(0, r["word_start"] - 3) : r["word_start"] + r["words"] + 3])
        assert plain_edit(items[k], part) == r["distance"]


def test_recall_of_edited_leaks(spark):
    sf_dir = "/root/testdata/sf0.01"
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    hosts = [r.text for r in documents(spark, sf_dir).limit(40).collect()]
    table = []
    for k, (_, text) in enumerate(items):
        body = list(text)
        for _ in range(int(0.08 * len(body))):
            at = rng.randrange(len(body))
            body[at] = rng.choice(["", "x", body[at] + "q"])
        words = hosts[k % 40].split()[:300]
        cut = rng.randrange(len(words) + 1)
        table.append((k, " ".join([*words[:cut], "".join(body).upper(), *words[cut:]])))
    found = {(r["doc_id"], r["item_id"]) for r in rows(decontaminate.leaks(spark.createDataFrame(table, "doc_id long, text string"), common.table(spark, sf_dir, "benchmark")))}
    assert sum((k, items[k][0]) in found for k in range(len(table))) >= 0.9 * len(table)


def test_decontamination_on_odd_rows(spark):
    benchmark = spark.createDataFrame([(1, "hello world again, one two three."), (2, None), (3, " "), (4, "word soup number 77 goes on and on. word soup number 78 goes on and on. word soup number 79 goes on and on.")], "item_id long, text string")
    out = {(r["doc_id"], r["item_id"]) for r in rows(decontaminate.leaks(odd(spark), benchmark, item_bytes_a_pass=40))}
    assert out == {(1, 1), (2, 1), (6, 4)}
    assert decontaminate.leaks(empty(spark), benchmark).count() == decontaminate.leaks(odd(spark), benchmark.limit(0)).count() == 0
    kept = decontaminate.without_leaks(odd(spark), benchmark)
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [3, 4, 5, 7, 8, 9, 10, 10]
