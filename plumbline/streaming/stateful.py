"""Deduplication, identities and batches as keyed state over event time.

The rules depend on the order of events, so each key holds its rows back until
the watermark has passed them and then replays them in order of ``(ts, uid)``.
Late rows (behind the watermark) are dropped by Spark; route them to a side
table before these operators if they matter.

Only rows between the watermark and now are held per key, which the watermark
delay bounds.  What a key remembers is cleared when it can change nothing any more:
300 ms after its last report, or when its identity would be renewed anyway.  A batch
is named after the flush before it, so that name stays.  The state store must be RocksDB:
``spark.sql.streaming.stateStore.providerClass`` set to
``org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_left

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from plumbline.operators.batching import BATCH_SIZE, FLUSH_SECONDS
from plumbline.operators.dedup import WINDOW_MS, params_fingerprint
from plumbline.operators.identity import IDLE_MS, MAX_AGE_MS, stream_uuid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WATERMARK = "10 minutes"

_PLACE = T.StructType([T.StructField("minute", T.LongType()), T.StructField("part", T.LongType())])
_MINUTE_MS = 60_000
_ROWS = T.StructType([T.StructField("json", T.StringType())])
_MEMORY = T.StructType([T.StructField("json", T.StringType())])
#: rows that are held as one value where they fill more than a minute, and rows that are replayed at once
_TOGETHER, _PORTION = 500, 5_000
#: a longer value is not appended to
_LONG = 1 << 20
#: characters of arriving rows that are put in order together, and what a row adds to those of its text
_SORTED, _ROW = 1 << 25, 200


class _InOrder(StatefulProcessor):
    """Holds rows until the watermark passes them, then hands them to ``replay`` in order.

    Rows wait in chunks under the minute of their first one: a chunk ends at the first full minute
    that leaves it with ``_TOGETHER`` rows, so sparse rows of many minutes are one value and a dense
    minute is one or several.  Arriving rows come in any order, so many of them are sorted together:
    the time that a chunk takes up, and with it how many are open at once, would grow with the input
    otherwise.  A key has a single timer, for the first row it holds.  When that is due, chunks are
    read in order and replayed in portions; a chunk that has only begun to be due is held anew, and
    the others are left alone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", _PLACE, _ROWS)
        self.memory = handle.getValueState("memory", _MEMORY)

    def _append(self, minute: int, rows: list) -> None:
        part = 0
        while self.waiting.containsKey((minute, part + 1)):
            part += 1
        found = self.waiting.getValue((minute, part))
        text = json.dumps(rows)
        if found is not None and len(found[0]) < _LONG:
            text = f"{found[0][:-1]},{text[1:]}"
        elif found is not None:
            part += 1
        self.waiting.updateValue((minute, part), (text,))

    def _hold(self, rows: list) -> None:
        """Add rows, which are in order of time, to what waits."""
        chunk: list = []
        for row in rows:
            if len(chunk) >= _TOGETHER and row[0] // _MINUTE_MS != chunk[-1][0] // _MINUTE_MS:
                self._append(chunk[0][0] // _MINUTE_MS, chunk)
                chunk = []
            chunk.append(row)
        if chunk:
            self._append(chunk[0][0] // _MINUTE_MS, chunk)

    def _wake(self, ms: int, fired: int | None = None) -> None:
        """Have a timer at ``ms`` or before, and none after it; those up to ``fired`` are about to go."""
        timers = [t for t in self.handle.listTimers() if fired is None or t > fired]
        if min(timers, default=ms + 1) > ms:
            self.handle.registerTimer(ms)
            for later in timers:
                self.handle.deleteTimer(later)

    def _sorted(self, rows):
        """Arriving rows in lists, each in order of time; a list has rows of many batches."""
        new, size = [], 0
        for pdf in rows:
            for m, u, d in zip(pdf["ms"], pdf["uid"], pdf["data"]):
                new.append((int(m), u, d))
                size += len(d or "") + _ROW
                if size >= _SORTED:
                    new.sort(key=lambda r: r[0])
                    yield new
                    new, size = [], 0
        if new:
            new.sort(key=lambda r: r[0])
            yield new

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for new in self._sorted(rows):
            self._hold(new)
            first = new[0][0] if first is None else min(first, new[0][0])
        if first is not None:
            self._wake(first + 1)
        yield pd.DataFrame([], columns=self.columns, dtype=object)

    def _due(self, passed: int):
        """Rows before ``passed`` in order, in portions; what else was read is held anew.

        No later chunk has a row before its minute, so rows before the next minute are complete.
        """
        places = sorted(tuple(k) for k in self.waiting.keys())
        begun = [p for p in places if p[0] * _MINUTE_MS < passed]
        held: list = []
        rest: list = []
        left = 0  # rows held that were sorted before: as many others come first, so that no row is sorted often
        for i, place in enumerate(begun):
            for row in json.loads(self.waiting.getValue(place)[0]):
                (held if row[0] < passed else rest).append(tuple(row))
            self.waiting.removeKey(place)
            until = begun[i + 1][0] * _MINUTE_MS if i + 1 < len(begun) else passed
            if len(held) >= max(_PORTION, 2 * left) and until > place[0] * _MINUTE_MS or i + 1 == len(begun):
                held.sort(key=lambda r: (r[0], r[1] or ""))
                ready = bisect_left(held, until, key=lambda r: r[0])
                if ready:
                    yield held[:ready]
                    held = held[ready:]
                left = len(held)
        rest.sort(key=lambda r: r[0])
        self._hold(rest)
        starts = [r[0] for r in rest[:1]] + [p[0] * _MINUTE_MS for p in places[len(begun) :][:1]]
        self.next_ms = min(starts, default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        memory = json.loads(self.memory.get()[0]) if self.memory.exists() else None
        replayed = False
        for rows in self._due(passed):
            out, memory = self.replay(key, rows, memory)
            replayed = True
            if out:
                yield pd.DataFrame(out, columns=self.columns, dtype=object)
        wake = [] if self.next_ms is None else [self.next_ms + 1]
        if memory is not None:
            end = self.end_of(memory)
            if end is not None and end < passed:
                self.memory.clear()
            else:
                if replayed:
                    self.memory.update((json.dumps(memory),))
                if end is not None:
                    wake.append(end + 1)
        if wake:
            self._wake(min(wake), passed)

    def end_of(self, memory) -> int | None:
        """Event time from which ``memory`` changes nothing any more; None if it always counts."""
        return None

    def close(self) -> None:
        pass


class _Dedup(_InOrder):
    columns = ["uid"]

    def replay(self, key, rows, memory):
        pending, out = memory or [], []
        for ms, uid, data in rows:
            source, params = data.split("|", 1)
            pending = [p for p in pending if ms - p[0] <= WINDOW_MS]
            if any(p[1] != source and p[2] == params for p in pending):
                pending = []
            else:
                pending.append((ms, source, params))
                out.append((uid,))
        return out, pending


    def end_of(self, memory):
        return max((p[0] for p in memory), default=0) + WINDOW_MS


class _Identity(_InOrder):
    columns = ["client_id", "uid", "created"]

    def replay(self, key, rows, memory):
        created, last = memory or (None, None)
        out = []
        for ms, uid, _ in rows:
            if created is None or (ms - created > MAX_AGE_MS and ms - last > IDLE_MS):
                created = ms
            last = ms
            out.append((key[0], uid, created))
        return out, None if created is None else (created, last)

    def end_of(self, memory):
        # a later event renews the identity, whatever it was
        return 0 if memory is None else max(memory[0] + MAX_AGE_MS, memory[1] + IDLE_MS)


class _Batches(_InOrder):
    columns = ["uid", "batch_id", "flush"]

    def __init__(self, size: int, seconds: int):
        self.size, self.wait_ms = size, seconds * 1000

    def replay(self, key, rows, memory):
        waiting, flushed_ms, flushed = memory or (0, rows[0][0] if rows else 0, "start")
        out = []
        for ms, uid, _ in rows:
            waiting += 1
            flush = waiting % self.size == 0 or ms - flushed_ms >= self.wait_ms
            out.append((uid, f"{key[0]}|{flushed}", flush))
            if flush:
                waiting, flushed_ms, flushed = 0, ms, uid
        return out, (waiting, flushed_ms, flushed)


def _stateful(events: DataFrame, keys: list[str], data, processor: StatefulProcessor, schema: str) -> DataFrame:
    rows = events.select(*keys, "uid", "ts", F.unix_millis("ts").alias("ms"), data.alias("data"))
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "append", "EventTime")


def dedup_stream(events: DataFrame) -> DataFrame:
    """Uids of the events to keep (E1).  ``events`` carry a watermark on ``ts``."""
    data = F.concat_ws("|", "source", params_fingerprint(F.col("props")))
    return _stateful(events, ["client_id", "event_name"], data, _Dedup(), "uid string")


def identify_stream(events: DataFrame) -> DataFrame:
    """``uid`` and ``stream_id`` (F1)."""
    schema = "client_id string, uid string, created long"
    named = _stateful(events, ["client_id"], F.lit(""), _Identity(), schema)
    return named.select("uid", stream_uuid(F.col("client_id"), F.col("created")).alias("stream_id"))


def batch_stream(events: DataFrame, size: int = BATCH_SIZE, seconds: int = FLUSH_SECONDS) -> DataFrame:
    """``uid``, ``batch_id`` and ``flush`` (G1)."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    return _stateful(events, ["client_id"], F.lit(""), _Batches(size, seconds), "uid string, batch_id string, flush boolean")


def write_routed(documents: DataFrame, path: str, checkpoint: str):
    """Write the stateless middle of an inspection, in one folder per micro-batch and route.

    A repeated micro-batch overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.drop("results").write.mode("overwrite").partitionBy("route").parquet(f"{path}/micro_batch={batch_id}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
