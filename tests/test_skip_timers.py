"""A skip list sets one timer for each call, whatever the number of rows that pass."""

from __future__ import annotations

import pandas as pd

from quern.streaming import stateful


class Store:
    """The handle and the value of a key, with the calls that came."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_one_timer_a_call():
    store, skip = Store(), stateful.Skip(10)
    skip.init(store)
    frame = lambda *at: iter([pd.DataFrame({"at_ms": at, "event_id": at})])
    assert list(next(skip.handleInputRows((1,), frame(30, 0, 5, 10, 19, 20), None))["event_id"]) == [0, 10, 20, 30]
    assert store.calls == 1 and store.timers == {40}
    assert list(skip.handleInputRows((1,), frame(39), None)) == []
    assert list(next(skip.handleInputRows((1,), frame(40, 55), None))["event_id"]) == [40, 55]
    assert store.calls == 3 and store.timers == {65} and store.value == (65,)
