"""Token ids against the library itself, and offsets through select."""

from __future__ import annotations

import numpy as np
import pytest
from fixtures import odd

from quern.llm import queries, token_store
from quern.llm.tokens import Encoder

FILES = [(queries.BYTE_TOKENIZER, False), (queries.WORD_TOKENIZER, True)]
SPECIAL = ["<|endoftext|> hi", "hi<|endoftext|>", "<|startoftext|> a <|EndOfText|>", "a <|endoftext |> b", "<| a"]


def library(name, special):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(queries.tokenizer_path(name))
    if not special:
        tk.encode_special_tokens = True
    return lambda text: tk.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "drops"), FILES)
@pytest.mark.parametrize("special", [False, True])
def test_every_letter_beside_a_mark(name, drops, special):
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["x ड़. y", "İ. ki̇.", *SPECIAL]
    for i in range(0, len(points), 400):
        part = points[i : i + 400]
        texts += [" ".join(f"x{c}." for c in part), " ".join(f"{c},Q" for c in part), "y " + " ".join(f".{c}" for c in part)]
    mine, plain = Encoder(queries.tokenizer_path(name), drops, special), library(name, special)
    for k in range(0, len(texts), 200):
        part = texts[k : k + 200]
        assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(part)] == [plain(t) for t in part]


@pytest.mark.parametrize(("name", "drops"), FILES)
def test_forgetting_chunks_changes_nothing(name, drops, monkeypatch):
    from quern.llm import tokens

    monkeypatch.setattr(tokens, "CHUNKS_KNOWN", 20)
    monkeypatch.setattr(tokens, "TEXT_AT_ONCE", 50)
    texts = [f"word{k % 7} and more{k}, Some. other\nthing{k % 31}" for k in range(300)]
    mine, plain = Encoder(queries.tokenizer_path(name), drops), library(name, False)
    assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(texts)] == [plain(t) for t in texts]
    assert mine.encode([]) == []


def test_one_document_is_read_through_select(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_TOKENS", 50)
    path = f"file://{tmp_path}/store"
    token_store.write_store(odd(spark), path, queries.tokenizer_path(queries.BYTE_TOKENIZER), 2)
    rows = token_store.read_store(spark, path, with_ids=True).orderBy("start").collect()
    for k in (0, 1, 5, len(rows) - 1):
        assert token_store.read_document(spark, path, k) == list(rows[k].ids)
    assert token_store.read_document(spark, path, len(rows)) is None


def test_ranges_of_an_elias_fano_code():
    values = np.sort(np.random.default_rng(3).integers(0, 10**7, 1000))
    code = token_store.EliasFano(*token_store.EliasFano.encode(values), len(values))
    for i, j in ((0, 1), (63, 65), (64, 128), (999, 1000), (10, 700)):
        assert code.range(i, j).tolist() == values[i:j].tolist()
    assert list(code.spans()) == list(zip([0, *values[:-1].tolist()], values.tolist(), strict=True))
