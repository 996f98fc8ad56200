"""A page costs a few calls of the state store a micro-batch, whatever the number of its blocks."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from quern.streaming import stateful


class Value:
    def __init__(self, store):
        self.store, self.value, self.words = store, None, {}

    def get(self):
        self.store.calls += 1
        return self.value

    def update(self, value):
        self.store.calls += 1
        self.value = value

    def clear(self):
        self.store.calls += 1
        self.value, self.words = None, {}

    def getValue(self, key):
        self.store.calls += 1
        return self.words.get(key)

    def updateValue(self, key, value):
        self.store.calls += 1
        self.words[key] = value


class Store:
    """The handle of one key, with the number of calls that came."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value(self))

    def getMapState(self, name, key, value):
        return self.states.setdefault(name, Value(self))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


@pytest.fixture
def page():
    store, pages = Store(), stateful.Completion(100)
    pages.init(store)

    def add(blocks, expected, at):
        before = store.calls
        rows = iter([Row(block=b, expected=expected, at_ms=at) for b in blocks])
        return [tuple(r) for r in pages.handleInputRows(("p",), rows, None)], store.calls - before

    def expire(at, watermark):
        store.timers.discard(at)
        info, times = SimpleNamespace(getExpiryTimeInMs=lambda: at), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        return [tuple(r) for r in pages.handleExpiredTimer(("p",), times, info)]

    return SimpleNamespace(store=store, add=add, expire=expire)


def test_calls_do_not_grow_with_blocks(page):
    found, calls = page.add(range(0, 1000, 2), 1000, 5)
    assert (found, calls <= 5) == ([], True)
    found, calls = page.add([*range(1, 1000, 2), 7, 8], 1000, 6)
    assert (found, calls <= 5) == ([("p", 1000, True)], True)
    assert not page.store.states["blocks"].words
    assert page.add([3], 1000, 7)[0] == []


@pytest.mark.parametrize("at_once", [1, 2, 1 << 16])
def test_blocks_count_once_wherever_they_lie(page, monkeypatch, at_once):
    monkeypatch.setattr(stateful, "BLOCKS_AT_ONCE", at_once)
    assert page.add([-1, -5000, 0, 0, 1 << 40], 6, 5)[0] == []
    assert page.add([1 << 40, -1, 4096], 6, 5)[0] == []
    assert page.add([4095], 6, 5)[0] == [("p", 6, True)]


def test_timer_follows_the_latest_row(page):
    page.add([1], 3, 10)
    page.add([2], 3, 50)
    assert page.store.timers == {110}
    assert page.expire(110, 120) == [] and page.store.timers == {150}
    page.add([2], 3, 60)
    assert page.expire(150, 161) == [("p", 2, False)]  # its time, 160, is over as well
    assert page.store.timers == set()
    assert page.store.states["done"].value is None and not page.store.states["blocks"].words


def test_page_that_is_complete_at_once_is_not_told_again(page):
    assert page.add([1, 2, 2], 2, 10)[0] == [("p", 2, True)]
    assert page.add([1, 2], 2, 20)[0] == []
    assert page.expire(110, 115) == [] and page.expire(120, 121) == []
