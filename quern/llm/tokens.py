"""Exact, memoised encoding with a public tokenizer file.

A pre-tokenizer never joins text across a single space between two visible characters. So texts are cut there, each
distinct chunk of a batch is looked up once, chunks that a worker has not met lately are encoded by the tokenizers
library, and ids are put together by index. Texts in which a cut is not provably neutral (runs of white space, spaces at
either end) are encoded whole by the library.

The string of a special token in a text is ordinary text, as the README of the tokenizer files advises (a document must
not be able to forge an end mark). With special_in_text it becomes the token, which is the library's own default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quern.llm.common import env_threads_off, held, strings

#: Chunks a worker remembers, at about 40 bytes each; beyond it those that were not met for longest are forgotten.
CHUNKS_KNOWN = 400_000
#: Characters of text that are cut and put together at once (a longer text alone).
TEXT_AT_ONCE = 4 << 20
#: Unseen chunks that are encoded as one text.
CHUNKS_AT_ONCE = 2_000
#: Marks whose run at a chunk's end is a unit of its own after a letter. The apostrophe may open a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# White space other than the space and the line feed, in ASCII and beyond.
RARE_ASCII_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f"
RARE_SPACE = RARE_ASCII_SPACE + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: How byte-level vocabularies write the space.
SPACE_BYTE = "\u0120"


def only_latin1(text: str) -> bool:
    """Whether lower-casing the text first is what the tokenizer does itself: no composition, no context in casing."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """The ids of texts, as unsigned 32-bit integers."""

    def __init__(self, path: str, drops_space: bool, special_in_text: bool = False):
        """drops_space: the tokenizer discards white space, so any cut at a space or line feed is neutral."""
        env_threads_off()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_in_text
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()] if special_in_text else []
        # how words of plain letters can be cut: there is nothing to normalise, and spaces are the only places
        at_spaces = pre_tokenizers.Split(" ", "removed" if drops_space else "merged_with_next")
        self.plain_cut = pre_tokenizers.Sequence([at_spaces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.own_cut, self.own_normalizer = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        self.drops_space = drops_space
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met, self.turn = np.zeros(0, dtype=np.int64), 0
        if drops_space:
            (self.mark,) = self.tokenizer.encode("0", add_special_tokens=False).ids
        else:
            vocabulary = self.tokenizer.get_vocab()
            (self.line,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
            self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.opens[[i for t, i in vocabulary.items() if t.startswith(SPACE_BYTE)]] = True

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def plainly(self, words: str) -> bytes:
        """The ids of space-separated words of plain letters, without the tokenizer's own pattern and normaliser."""
        self.tokenizer.pre_tokenizer, self.tokenizer.normalizer = self.plain_cut, None
        try:
            return self.whole([words])[0]
        finally:
            self.tokenizer.pre_tokenizer, self.tokenizer.normalizer = self.own_cut, self.own_normalizer

    def spaced(self, text: str) -> str | None:
        """The text with a space wherever it may be cut, or None if it has to be encoded whole. Each part but the first
        stands for itself with the space before it, or with the line feed that it begins with. Where white space is
        discarded, empty parts are harmless."""
        if not text or any(map(text.__contains__, self.special)):
            return None
        if self.drops_space:
            if only_latin1(text):
                text = text.lower()
            return text.replace("\n", " ")
        if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or any(map(text.__contains__, RARE_ASCII_SPACE if text.isascii() else RARE_SPACE)):
            return None
        return text if "\n\n" in text else text.replace("\n", " \n")

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of chunks. Most are encoded as parts of long texts, whose ids tell where each chunk ends: at a digit's
        own id put between them, or where a token holds the space that opens the next chunk."""
        found: dict[str, bytes] = {}
        mark = " 0 " if self.drops_space else ""
        letters = [c for c in new if c.isalpha()]
        others = [c for c in new if not c.isalpha()] if len(letters) < len(new) else []
        lines: list[str] = []
        if self.drops_space:
            odd = [c for c in others if "0" in c]
            found.update(zip(odd, self.whole(odd), strict=True))
            others = [c for c in others if "0" not in c]
        else:
            lines = [c for c in others if c[0] == "\n"]
            others = [c for c in others if c[0] != "\n"]
        for plain in (letters, others, lines):
            groups = [plain[i : i + CHUNKS_AT_ONCE] for i in range(0, len(plain), CHUNKS_AT_ONCE)]
            for group in groups:
                joined = mark.join(group) if self.drops_space or plain is lines else " " + " ".join(group)
                simple = plain is letters and only_latin1(joined) and (not self.drops_space or joined == joined.lower())
                ids = np.frombuffer(self.plainly(joined) if simple else self.whole([joined])[0], dtype="<u4")
                if self.drops_space:
                    marks = np.flatnonzero(ids == self.mark)
                    ends = np.append(marks, len(ids)).tolist()
                    starts = [0, *(marks + 1).tolist()]
                else:
                    starts = np.flatnonzero(ids == self.line if plain is lines else self.opens[ids]).tolist()
                    ends = [*starts[1:], len(ids)]
                raw = ids.tobytes()
                found.update(zip(group, [raw[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)], strict=True))
        return found

    def learn_all(self, new: list[str]) -> list[bytes]:
        """The ids of distinct chunks that are not known yet."""
        # a run of marks behind a letter is a unit of its own; only where neither side can be changed by normalising
        base_of = {c: base for c in new if c[-1:] in MARKS and (base := c.rstrip(MARKS))[-1:].isalpha() and only_latin1(base)}
        bases = list(set(base_of.values()))
        at = pc.index_in(pa.array(bases, pa.large_string()), value_set=self.known).to_pylist()
        found = {base: self.ids[k].as_py() for base, k in zip(bases, at, strict=True) if k is not None}
        found[""] = b""
        found.update(self.learn(list({c for c in new if c not in base_of}.union(bases).difference(found))))
        tails = list({c[len(base) :] for c, base in base_of.items()})
        of_tail = dict(zip(tails, self.whole(tails), strict=True))
        return [found[base] + of_tail[c[len(base) :]] if (base := base_of.get(c)) is not None else found[c] for c in new]

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts one after the other, how many each text has)."""
        ids, sizes, part, held = [], [], [], 0
        for k, t in enumerate(texts):
            part.append(t)
            held += len(t)
            if held >= TEXT_AT_ONCE or k + 1 == len(texts):
                a, b = self._part(part)
                ids.append(a)
                sizes.append(b)
                part, held = [], 0
        return (np.concatenate(ids) if ids else np.zeros(0, dtype="<u4")), (np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64))

    def _part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.spaced(t) for t in texts]
        # a text without cuts is one empty word here; its ids are put in behind those of the chunks
        words = pc.split_pattern(pa.array(["" if c is None else c for c in cut], pa.large_string()), " ")
        offsets = words.offsets.to_numpy()
        if len(self.known) > CHUNKS_KNOWN:
            keep = pa.array(np.sort(np.argpartition(-self.met, CHUNKS_KNOWN // 2)[: CHUNKS_KNOWN // 2]))
            self.known, self.ids, self.met = self.known.take(keep), self.ids.take(keep), self.met[keep.to_numpy()]
        # what is known comes first, so an index beyond it is a chunk that is not
        coded = pa.concat_arrays([self.known, words.values]).dictionary_encode()
        index = coded.indices.to_numpy()[len(self.known) :].astype(np.int64)
        new = coded.dictionary[len(self.known) :].to_pylist()
        learned = pa.array(self.learn_all(new), pa.large_binary())
        self.known, self.ids = coded.dictionary, pa.concat_arrays([self.ids, learned])
        self.turn += 1
        self.met = np.concatenate([self.met, np.zeros(len(new), dtype=np.int64)])
        self.met[index] = self.turn
        alone = [k for k, c in enumerate(cut) if c is None]
        single = [texts[k] for k in alone]
        if not self.drops_space:  # a text's first part has no space before it
            first = [k for k, c in enumerate(cut) if c is not None]
            single += [cut[k].split(" ", 1)[0] for k in first]
            alone += first
        index[offsets[:-1][alone]] = len(self.known) + np.arange(len(alone))
        body = pa.concat_arrays([self.ids, pa.array(self.whole(single), pa.large_binary())]).take(pa.array(index))
        at = np.frombuffer(body.buffers()[1], dtype=np.int64)[: len(index) + 1] // 4
        return np.frombuffer(body.buffers()[2] or b"", dtype="<u4")[: at[-1]], np.diff(at[offsets])

    def encode(self, texts: list[str]) -> list[bytes]:
        """One bytes object of little-endian unsigned 32-bit ids for each text."""
        ids, sizes = self.flat(texts)
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes).tolist()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]


def encoded(batches: Iterator[pa.RecordBatch], encode: Encoder) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(ids, token ids of each text) of batches with doc_id and text (null counts as empty), TEXT_AT_ONCE characters at once."""
    keys: list[int | None] = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True):
            keys.append(key)
            texts.append(text)
            held += len(text)
            if held >= TEXT_AT_ONCE:
                yield keys, encode.encode(texts)
                keys, texts, held = [], [], 0
    if keys:
        yield keys, encode.encode(texts)


def encoder(path: str, drops_space: bool) -> Encoder:
    """One encoder, with its memory, for each tokenizer file and worker."""
    return held(("encoder", path, drops_space), lambda: Encoder(path, drops_space))
