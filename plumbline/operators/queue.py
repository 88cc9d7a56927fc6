"""The outgoing queue with its answers: failed batches come back and count again (G1, G2, G7 together).

An arrival joins the queue's end; if the queue then holds a multiple of ``size`` rows, or the last
flush is ``seconds`` old, all of it is sent as one batch.  A batch whose sending failed comes back
behind what has arrived since, so it changes when the next batch is full.  After an arrival and
after an answer the newest ``limit`` places of the queue stay and the rest is lost.

What happens next depends on all that happened before, so a client's queue is replayed in order.
The rows are sorted by client and time and streamed through the replay: a task holds one
queue and the batches that wait for an answer, never the rows of a client.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.batching import BATCH_SIZE, FLUSH_SECONDS, QUEUE_LIMIT

#: a batch without an answer for so long counts as sent
ANSWER_MS = 600_000
#: answers count before arrivals of the same instant
ANSWER, ARRIVAL = 0, 1
SENT, LOST = "sent", "lost"
_OUT = {"client_id": "string", "uid": "string", "fate": "string", "batch_id": "string", "place": "int", "at_ms": "long"}
_BATCH = 20_000


@dataclass
class Queue:
    """One client's queue."""

    client: str
    size: int
    wait_ms: int
    limit: int
    rows: list[str] = field(default_factory=list)
    open: list[tuple[int, str, list[str]]] = field(default_factory=list)  # sent_ms, batch_id, rows; without an answer yet
    flushed_ms: int | None = None
    flushed: str = "start"

    def arrive(self, ms: int, uid: str) -> Iterator[tuple]:
        """What leaves the queue with an arrival: (uid, fate, batch_id, place)."""
        self.rows.append(uid)
        if self.flushed_ms is None:
            self.flushed_ms = ms
        yield from self._trim()
        if len(self.rows) % self.size == 0 or ms - self.flushed_ms >= self.wait_ms:
            name = f"{self.client}|{self.flushed}"
            yield from ((u, SENT, name, i) for i, u in enumerate(self.rows))
            self.open = [b for b in self.open if ms - b[0] <= ANSWER_MS] + [(ms, name, self.rows)]
            self.rows, self.flushed_ms, self.flushed = [], ms, uid

    def answer(self, ms: int, batch_id: str | None, ok: bool) -> Iterator[tuple]:
        """What leaves the queue with an answer to a batch; without a name it answers the oldest open one."""
        self.open = [b for b in self.open if ms - b[0] <= ANSWER_MS]
        at = next((i for i, b in enumerate(self.open) if batch_id in (None, b[1])), None)
        if at is None:
            return
        _, _, rows = self.open.pop(at)
        if not ok:
            self.rows = self.rows + rows
            yield from self._trim()

    def _trim(self) -> Iterator[tuple]:
        over = max(0, len(self.rows) - self.limit)
        yield from ((u, LOST, None, None) for u in self.rows[:over])
        self.rows = self.rows[over:]

    def state(self) -> list:
        return [self.rows, self.open, self.flushed_ms, self.flushed]

    def restore(self, state: list) -> Queue:
        self.rows, self.open, self.flushed_ms, self.flushed = state
        return self


def queue_rows(arrivals: DataFrame, answers: DataFrame) -> DataFrame:
    """client, ms, kind, uid, batch_id, ok and ts of arrivals (``uid, client_id, ts``) and answers (``client_id, ts, batch_id, ok``)."""
    client = F.coalesce(F.col("client_id"), F.lit("unknown")).alias("client")
    nothing = lambda kind: F.lit(None).cast(kind)
    come = arrivals.select(client, F.unix_millis("ts").alias("ms"), F.lit(ARRIVAL).alias("kind"), F.coalesce("uid", F.lit("")).alias("uid"), nothing("string").alias("batch_id"), nothing("boolean").alias("ok"), "ts")
    told = answers.select(client, F.unix_millis("ts").alias("ms"), F.lit(ANSWER).alias("kind"), F.lit("").alias("uid"), "batch_id", F.coalesce("ok", F.lit(False)).alias("ok"), "ts")
    return come.unionByName(told)


def replay_queue(
    arrivals: DataFrame, answers: DataFrame, size: int = BATCH_SIZE, seconds: int = FLUSH_SECONDS, limit: int = QUEUE_LIMIT, left: bool = True
) -> DataFrame:
    """client_id, uid, fate, batch_id, place, at_ms: every time a row is sent or lost.

    A row that is sent again has a row for each batch.  With ``left``, rows that still wait at the
    end follow, with fate ``waiting``.  Answers without ``ok`` are failures; rows without a client
    share the queue ``unknown``; rows that repeat an id are rows of their own.
    """
    if size < 1 or limit < 1:
        raise ValueError("batch size and queue limit must be at least 1")
    names = list(_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, out, last = None, [], 0

        def ended() -> list[tuple]:
            return [(queue.client, u, "waiting", None, i, last) for i, u in enumerate(queue.rows)] if queue and left else []

        def packed() -> pa.RecordBatch:
            types = [pa.string()] * 4 + [pa.int32(), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for client, ms, kind, uid, batch_id, ok in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if queue is None or client != queue.client:
                    out += ended()
                    queue = Queue(client, size, seconds * 1000, limit)
                gone = queue.arrive(ms, uid) if kind == ARRIVAL else queue.answer(ms, batch_id, ok)
                out += [(client, *g, ms) for g in gone]
                last = ms
                if len(out) >= _BATCH:
                    yield packed()
                    out = []
        out += ended()
        yield packed()

    order = ["client", "ms", "kind", "uid", "batch_id"]
    rows = queue_rows(arrivals, answers).drop("ts").repartition("client").sortWithinPartitions(*order)
    return rows.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in _OUT.items()))


def queue_data(rows: DataFrame) -> Column:
    """The part of a row that a stream's state holds."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in ("kind", "uid", "batch_id", "ok")]))


def replay_held(queue: Queue, rows: list[tuple[int, str, str]]) -> list[tuple]:
    """Rows of a stream's state through the queue."""
    out = []
    for ms, _, data in rows:
        kind, uid, batch_id, ok = json.loads(data)
        gone = queue.arrive(ms, uid) if int(kind) == ARRIVAL else queue.answer(ms, batch_id, ok == "true")
        out += [(queue.client, *g, ms) for g in gone]
    return out
