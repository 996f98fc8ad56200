"""Words of many texts as arrays, with hashes of runs of bytes or words taken from prefix sums.

Words are what lies between ASCII white space, compared with A-Z lower-cased. A hash is a polynomial modulo 2**64 over
random values for its bytes (or words); two of them make 128 bits, by which words are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are handled together (a longer text alone), and bytes whose words are hashed together.
BYTES_AT_ONCE, HASHED_AT_ONCE = 1 << 20, 1 << 20
SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8))
LANES = 2
_random = np.random.default_rng(17)
BYTE_VALUES = _random.integers(0, 1 << 63, size=(LANES, 256), dtype=np.uint64)
BYTE_VALUES[:, 65:91] = BYTE_VALUES[:, 97:123]
#: Odd, so that they have inverses modulo 2**64.
BYTE_BASES, WORD_BASES = ([int(x) * 8 + 3 for x in _random.integers(0, 1 << 60, size=LANES)] for _ in range(2))
MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _powers(base: int, bits: int) -> np.ndarray:
    """base**0 to base**(2**bits - 1) modulo 2**64."""
    return np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full((1 << bits) - 1, base, dtype=np.uint64))])


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of values[start:end] for each run, the same wherever the run lies."""
    bits = max(10, int(len(values) + 1).bit_length())
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(base, bits)[: len(values)], dtype=np.uint64)])
    out = (sums[ends] - sums[starts]) * _powers(pow(base, -1, 1 << 64), bits)[starts]
    out = (out ^ out >> np.uint64(32)) * MIX
    return out ^ out >> np.uint64(29)


class Words:
    """The words of texts that lie one after the other in data: starts, ends, text_of and hashes (one row a lane)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets = offsets
        word = ~SPACES[data]
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        edges = offsets[offsets < len(data)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        self.starts, self.ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        self.text_of = np.searchsorted(offsets, self.starts, side="right") - 1
        self.hashes = np.zeros((LANES, len(self.starts)), dtype=np.uint64)
        i = 0
        while i < len(self.starts):
            a = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, a + HASHED_AT_ONCE, side="right")))
            part = data[a : int(self.ends[j - 1])]
            for lane in range(LANES):
                self.hashes[lane, i:j] = run_hashes(BYTE_VALUES[lane][part], self.starts[i:j] - a, self.ends[i:j] - a, BYTE_BASES[lane])
            i = j


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, the texts' bytes, where each begins and the last ends) of an Arrow column of strings,
    BYTES_AT_ONCE together; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BYTES_AT_ONCE, side="right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
