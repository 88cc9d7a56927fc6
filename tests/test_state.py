"""Rows that wait in a state: every one comes out once, in order, when the watermark passes it, for few accesses and timers."""

import json
import random

import pandas as pd
import pytest

from plumbline.streaming.stateful import _Batches, _InOrder


class Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)

    def containsKey(self, key):
        return key in self


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    """The state of one key."""

    def __init__(self):
        self.timers, self.map, self.value, self.fired = set(), Map(), Value(), 0

    def getMapState(self, *of):
        return self.map

    def getValueState(self, *of):
        return self.value

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)

    def listTimers(self):
        return iter(sorted(self.timers))


class Now:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


class Echo(_InOrder):
    columns = ["ms", "uid", "data"]

    def replay(self, key, rows, memory):
        assert rows
        return rows, (memory or 0) + len(rows)


def micro_batch(of, handle, rows, watermark, cut=10_000):
    """What a micro-batch gives: its rows come in, then the timers go that the watermark has passed."""
    frames = (pd.DataFrame(rows[i : i + cut], columns=["ms", "uid", "data"]) for i in range(0, len(rows), cut))
    out = [of.handleInputRows(("c",), frames, Now(watermark))] if rows else []
    got = [r for frame in out for f in frame for r in f.itertuples(index=False, name=None)]
    for ms in [t for t in sorted(handle.timers) if t <= watermark]:
        handle.fired += 1
        for f in of.handleExpiredTimer(("c",), Now(watermark), None):
            got += f.itertuples(index=False, name=None)
        handle.deleteTimer(ms)
    return got


@pytest.mark.parametrize("seed", range(6))
def test_rows_come_in_order_when_the_watermark_passes_them(seed):
    rng, handle, of = random.Random(seed), Handle(), Echo()
    of.init(handle)
    spread, watermark, waiting, n = rng.choice([2_000, 400_000, 90_000_000]), 0, [], 0
    for _ in range(30):
        rows = [(watermark + rng.randrange(spread), f"u{n + i}", "d") for i in range(rng.choice([0, 1, 40, 3_000]))]
        n += len(rows)
        waiting += rows
        watermark += rng.randrange(spread)
        got = micro_batch(of, handle, rows, watermark, cut=rng.choice([700, 10_000]))
        due = sorted(r for r in waiting if r[0] < watermark)
        assert got == due
        waiting = [r for r in waiting if r[0] >= watermark]
        assert len(handle.timers) <= 1 and bool(handle.timers) == bool(waiting)
    assert sorted(micro_batch(of, handle, [], 1 << 50)) == sorted(waiting)
    assert not handle.map and n > 100


def test_sparse_rows_share_values_and_a_timer():
    """A row a minute for 20,000 minutes took a value and a timer for each."""
    handle, of = Handle(), Echo()
    of.init(handle)
    rows = [(i * 60_000, f"{i:06d}", "d") for i in range(20_000)]
    assert micro_batch(of, handle, rows, 0) == []
    assert len(handle.map) <= 60 and len(handle.timers) == 1
    assert micro_batch(of, handle, [], 1 << 50) == rows
    assert handle.fired == 1


def test_a_dense_minute_is_several_values(monkeypatch):
    """No value is rewritten over and over, nor grows without end."""
    monkeypatch.setattr("plumbline.streaming.stateful._LONG", 10_000)
    handle, of = Handle(), Echo()
    of.init(handle)
    rows = [(7 * i % 60_000, f"{i:06d}", "x" * 50) for i in range(8_000)]
    for at in range(0, 8_000, 100):
        micro_batch(of, handle, rows[at : at + 100], 0)
    assert max(len(v[0]) for v in handle.map.values()) < 30_000
    assert micro_batch(of, handle, [], 1 << 50) == sorted(rows)


def test_a_batch_lasts_over_portions():
    handle, of = Handle(), _Batches(7, 10**9)
    of.init(handle)
    rows = [(i * 1_000, f"{i:06d}", "") for i in range(20_000)]
    micro_batch(of, handle, rows, 0)
    got = micro_batch(of, handle, [], 1 << 50)
    assert [g for _, _, g in got] == [i % 7 == 6 for i in range(20_000)]


def test_rows_of_many_batches_are_put_in_order_together():
    """Each Arrow batch had chunks over all of the time, and what was open at once was sorted for every minute."""

    class Counted(Echo):
        lists = 0

        def replay(self, key, rows, memory):
            self.lists += 1
            return super().replay(key, rows, memory)

    handle, of = Handle(), Counted()
    of.init(handle)
    rows = [(i * 1_000, f"{i:06d}", "d") for i in range(60_000)]
    mixed = random.Random(5).sample(rows, len(rows))
    assert micro_batch(of, handle, mixed, 0, cut=500) == []
    assert len(handle.map) >= 100
    spans = [(json.loads(v[0])[-1][0] - json.loads(v[0])[0][0]) for v in handle.map.values()]
    assert max(spans) <= 1_000 * 1_000  # of 60,000,000 ms
    assert micro_batch(of, handle, [], 1 << 50) == rows
    assert of.lists <= 2 * 60_000 // 5_000


def test_rows_are_sorted_in_portions(monkeypatch):
    monkeypatch.setattr("plumbline.streaming.stateful._SORTED", 100_000)
    handle, of = Handle(), Echo()
    of.init(handle)
    rows = [(i * 100, f"{i:06d}", "d") for i in range(30_000)]
    assert micro_batch(of, handle, random.Random(6).sample(rows, len(rows)), 0) == []
    assert micro_batch(of, handle, [], 1 << 50) == rows
