"""Processors that hold many keys in pages, on a store that counts how often it is asked."""

import random

import pandas as pd
import pytest

from millrace.streaming.pages import GROUP, KEY, Pages
from millrace.streaming.processors import MILLIS, FirstInWindow, FirstOfDay

DAY = 24 * 3600 * 1000


class Store:
    """States of one group as a processor sees them."""

    def __init__(self):
        self.calls, self.timers, self.states = 0, set(), {}

    def asked(self):
        self.calls += 1

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, MapOf(self))

    def getValueState(self, name, *schemas):
        return self.states.setdefault(name, ValueOf(self))

    def registerTimer(self, at):
        self.asked()
        self.timers.add(at)

    def deleteTimer(self, at):
        self.asked()
        self.timers.remove(at)


class ValueOf:
    def __init__(self, store):
        self.store, self.value = store, None

    def get(self):
        self.store.asked()
        return self.value

    def update(self, value):
        self.store.asked()
        self.value = value

    def clear(self):
        self.store.asked()
        self.value = None


class MapOf:
    def __init__(self, store):
        self.store, self.entries = store, {}

    def getValue(self, key):
        self.store.asked()
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.store.asked()
        self.entries[key] = value

    def clear(self):
        self.store.asked()
        self.entries = {}


class Times:
    def __init__(self, now=0, watermark=0):
        self.getCurrentProcessingTimeInMs, self.getCurrentWatermarkInMs = (lambda: now), (lambda: watermark)


class Expired:
    def __init__(self, at):
        self.getExpiryTimeInMs = lambda: at


def started(processor):
    store = Store()
    processor.init(store)
    return processor, store


def visits(rows):
    """(key, milliseconds, id) as a chunk of a group."""
    frame = pd.DataFrame(rows, columns=[KEY, MILLIS, "log_id"])
    return frame.assign(**{"ts": pd.to_datetime(frame[MILLIS], unit="ms"), GROUP: 7})


def marked(processor, rows, chunk=10_000, now=0):
    chunks = [visits(rows[k : k + chunk]) for k in range(0, len(rows), chunk)]
    return pd.concat(list(processor.handleInputRows((7,), iter(chunks), Times(now))))


def test_values_stay_as_pages_are_dealt_anew():
    store, expected, rnd = Store(), {}, random.Random(0)
    for _ in range(40):
        pages = Pages(store, "x", most=8)
        pages.open()
        for _ in range(25):
            key = f"k{rnd.randrange(600)}"
            assert pages.get(key) == expected.get(key)
            expected[key] = rnd.randrange(1000)
            pages.put(key, expected[key])
        pages.save()
    assert {key: pages.get(key) for key in expected if not pages.open()} == expected
    assert max(row[0].count(":") for row in store.states["x"].entries.values()) <= 16


def test_days_of_many_keys_are_few_questions():
    """A call and a question per key took most of the time of a stream."""
    processor, store = started(FirstOfDay(("ts", "log_id"), expire=True))
    first = [(f"k{k % 2000}", k * 1000, k) for k in range(6000)]
    assert len(marked(processor, first)) == 2000
    assert store.calls < 30
    store.calls = 0
    second = marked(processor, [(f"k{k}", DAY * (k % 2) + 8_000_000, k) for k in range(2000)])
    assert sorted(second["log_id"]) == list(range(1, 2000, 2)) and set(second["previous_day"]) == {"1970-01-01"}
    assert store.calls < 30


@pytest.mark.parametrize("keep_all", [False, True])
def test_days_against_a_walk_over_rows(keep_all):
    rnd = random.Random(3)
    processor, _ = started(FirstOfDay(("ts", "log_id"), keep_all=keep_all, expire=True))
    last, number = {}, 0
    for batch in range(4):
        rows = []
        for _ in range(500):
            number += 1
            rows.append((f"k{rnd.randrange(60)}", DAY * batch + rnd.randrange(2 * DAY), number))
        expected = {}
        for key, at, number_of in sorted(rows, key=lambda r: (r[1], r[2])):
            day = pd.Timestamp(at, unit="ms").strftime("%Y-%m-%d")
            expected[number_of] = (last.get(key), int(last.get(key) != day))
            last[key] = day
        got = marked(processor, rows, chunk=77)
        found = {r.log_id: (r.previous_day, r.is_first) for r in got.itertuples()}
        assert found == (expected if keep_all else {k: v for k, v in expected.items() if v[1]})


def test_days_go_away_by_the_timer():
    processor, store = started(FirstOfDay(("ts", "log_id"), expire=True))
    marked(processor, [("a", 1000, 1), ("b", DAY + 1000, 2)])
    assert store.timers == {3 * DAY}
    store.timers.clear()
    list(processor.handleExpiredTimer((7,), Times(watermark=3 * DAY), Expired(3 * DAY)))
    assert store.timers == {4 * DAY}
    assert marked(processor, [("a", 5000, 3), ("b", DAY + 2000, 4)])["log_id"].tolist() == [3]
    list(processor.handleExpiredTimer((7,), Times(watermark=9 * DAY), Expired(3 * DAY)))
    assert not store.states["last_days"].entries


def test_days_are_forgotten_after_their_time():
    processor, _ = started(FirstOfDay(("ts", "log_id"), ttl_millis=100))
    assert len(marked(processor, [("a", 1000, 1), ("b", 1000, 2)], now=0)) == 2
    assert len(marked(processor, [("a", 2000, 3), ("b", DAY, 4)], now=99)) == 1
    assert marked(processor, [("a", 3000, 5), ("b", DAY + 1, 6)], now=100)["log_id"].tolist() == [5]


def test_members_of_a_window_are_few_questions():
    processor, store = started(FirstInWindow("member", "ends"))

    def fresh(members):
        chunks = [pd.DataFrame({"member": pd.Series(m, dtype=object), "ends": 5000}) for m in members]
        return pd.concat(list(processor.handleInputRows((5000,), iter(chunks), Times())))["is_first"].tolist()

    assert fresh([["a", "b", None, "a"], ["b", "c"]]) == [1, 1, 0, 0, 0, 1]
    assert fresh([["c", "d", "d"]]) == [0, 1, 0] and store.timers == {5000}
    store.calls = 0
    assert sum(fresh([[f"m{k}" for k in range(3000)]])) == 3000
    assert store.calls < 40
    list(processor.handleExpiredTimer((5000,), Times(watermark=6000), Expired(5000)))
    assert fresh([["a"]]) == [1]
