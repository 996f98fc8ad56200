"""A worker gives memory back after a task, and another stage's model makes room for the next one's."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc

from quern.llm import common, langid


def kept_by_the_pool() -> int:
    """Megabytes of this process that are neither files nor shared."""
    with open("/proc/self/smaps_rollup") as f:
        return next(int(line.split()[1]) for line in f if line.startswith("Private_Dirty")) >> 10


def test_memory_is_given_back_when_batches_are_over():
    def run(batches):
        for n in batches:
            held = [pc.binary_repeat(pa.array(["x" * 50]), k % 7 + 1) for k in range(n)]
            yield len(held)

    calls, before = [], kept_by_the_pool()
    for n in common.gives_back(run)(iter([400_000])):
        calls.append((n, kept_by_the_pool()))
    (n, during), after = calls[0], kept_by_the_pool()
    assert n == 400_000 and during > before + 50
    assert after < before + (during - before) // 3


def test_dictionaries_take_the_place_of_another_model():
    common.held("tokenizer", lambda: "large")
    sent = SimpleNamespace(value={"en": b"the cat sat on the mat and ", "de": b"die Katze sitzt auf der Matte und "})
    first = langid.compressors("call", sent)
    assert set(common._held) == {"call"}
    assert langid.compressors("call", sent) is first
