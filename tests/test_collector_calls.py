"""The collector calls its state and timers only where they change."""

import datetime as dt

import pandas as pd

from tidemark.streaming.collector import Collector


class Handle:
    """State and timers of one item that note the calls."""

    def __init__(self):
        self.value, self.calls = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def registerTimer(self, at):
        self.calls.append("register")

    def deleteTimer(self, at):
        self.calls.append("delete")


def rows(*events):
    return pd.DataFrame([(pd.Timestamp(2024, 1, 1) + pd.Timedelta(seconds=s), turn, status) for s, turn, status in events], columns=["at", "turn", "status"])


def test_calls():
    handle, c = Handle(), Collector()
    c.init(handle)
    go = lambda *parts: [tuple(r) for f in c.handleInputRows(("k",), iter(parts), None) for r in f.itertuples(index=False)]
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    assert go(rows((9, 3, "seen")), rows((9, 2, "rate_limited"), (1, 1, "seen"))) == [("k", at(1), "publish", 0, 0)]
    assert handle.calls == ["register", "update"] and handle.value[1] == 1
    handle.calls.clear()
    assert list(c.handleInputRows(("k",), iter([rows((20, 4, "seen"))]), None)) == [] and handle.calls == []
    assert go(rows((200, 5, "success"))) == [("k", at(129), "fetch", 0, 1)] and handle.calls == ["delete", "update"]
    handle.calls.clear()
    assert list(c.handleInputRows(("k",), iter([rows((300, 6, "failed"))]), None)) == [] and handle.calls == []
