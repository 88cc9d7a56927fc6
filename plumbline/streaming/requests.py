"""Whole requests from a stream (P1, P2, P4): what ``outgoing_requests`` gives for a table.

Bodies are put together first, as all but the stream id in them depends on one report alone.  One
keyed state then does what depends on order: it drops doubles (E1, E2), names the identity (F1)
and writes it into the body, queues what waits (G1), and lets go of a request when its batch is
full or old.  A report goes through the state once, and only its body is held.

Rows without a client double nothing and have no identity; those that are sent at once pass
beside the state, the others share the queue ``unknown``, as they do in a table.
"""

from __future__ import annotations

import hashlib
import json
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from plumbline.operators.batching import BATCH_SIZE, FLUSH_SECONDS, sampling_draw
from plumbline.operators.dedup import WINDOW_MS, params_fingerprint, schema_fingerprint
from plumbline.operators.envelope import GZIP_MIN_LENGTH, App, event_body, write_bodies
from plumbline.operators.extract import extract_document
from plumbline.operators.identity import IDLE_MS, MAX_AGE_MS, UNKNOWN
from plumbline.plans.inspect import validate_documents
from plumbline.sources.specs import SpecTable
from plumbline.streaming.stateful import _InOrder, _stateful

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: columns of a report that is ready for the state
READY = "uid string, client_id string, event_name string, ts timestamp, source string, params string, shape string, body string, route string"
_NO_STREAM = ',"streamId":""'


class _Requests(_InOrder):
    columns = ["route", "batch_id", "n_events", "request", "gzip"]

    def __init__(self, size: int, seconds: int, whole: bool):
        self.size, self.wait_ms, self.whole = size, seconds * 1000, whole

    def _doubles(self, pending: dict, ms: int, name: str, source: str, params: str | None, shape: str | None) -> bool:
        """Apply the two deduplication rules; ``pending`` is brought up to date."""
        for other in list(pending):
            pending[other] = [p for p in pending[other] if ms - p[0] <= WINDOW_MS]
            if not pending[other] and other != name:
                del pending[other]
        live = pending.setdefault(name, [])
        if source == "schema":
            hit = next((i for i, p in enumerate(live) if p[1] == "codegen" and p[3] == shape and shape is not None), None)
            if hit is not None:
                live.pop(hit)
            return hit is not None
        if any(p[1] != source and p[2] == params for p in live):
            live.clear()
            return True
        live.append((ms, source, params, shape))
        return False

    def _request(self, route: str, batch_id: str, bodies: list[str]) -> tuple:
        request = "[" + ",".join(bodies) + "]"
        return route, batch_id, len(bodies), request, len(request) >= GZIP_MIN_LENGTH

    def replay(self, key, rows, memory):
        client = key[0]
        memory = memory or {"pending": {}, "created": None, "last": None, "queue": [], "flushed_ms": None, "flushed": "start"}
        out = []
        for ms, uid, data in rows:
            us, name, source, params, shape, body, route = json.loads(data)
            if self.whole and client is not None and self._doubles(memory["pending"], ms, name, source, params, shape):
                continue
            if body is None:
                continue
            if self.whole:
                stream = UNKNOWN
                if client is not None:
                    created, last = memory["created"], memory["last"]
                    if created is None or (ms - created > MAX_AGE_MS and ms - last > IDLE_MS):
                        memory["created"] = ms
                    memory["last"] = ms
                    stream = stream_id(client, memory["created"])
                body = body.replace(_NO_STREAM, f'{_NO_STREAM[:-1]}{stream}"', 1)
            if route == "immediate":
                out.append(self._request(route, f"event|{uid}", [body]))
                continue
            queue = memory["queue"]
            queue.append((int(us), uid, body))
            if memory["flushed_ms"] is None:
                memory["flushed_ms"] = ms
            if len(queue) % self.size == 0 or ms - memory["flushed_ms"] >= self.wait_ms:
                bodies = [b for _, _, b in sorted(queue, key=lambda r: (r[0], r[1]))]
                out.append(self._request("batch", f"{UNKNOWN if client is None else client}|{memory['flushed']}", bodies))
                memory.update(queue=[], flushed_ms=ms, flushed=uid)
        return out, memory

    def end_of(self, memory):
        if memory["flushed_ms"] is not None:
            return None  # the next batch is named after the last flush
        ends = [p[0] + WINDOW_MS for of in memory["pending"].values() for p in of]
        if memory["created"] is not None:
            ends.append(max(memory["created"] + MAX_AGE_MS, memory["last"] + IDLE_MS))
        return max(ends, default=0)


def stream_id(client: str, created_ms: int) -> str:
    """``stream_uuid`` of one client."""
    digest = hashlib.sha256(f"{client}|{created_ms}".encode()).hexdigest()
    return "-".join(digest[a:b] for a, b in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32)))


# ------------------------------------------------------------------- reports


def _ready(reports: DataFrame, body: Column) -> DataFrame:
    named = reports.withColumns({"params": params_fingerprint(F.col("props")), "body": body})
    shape = F.col("shape") if "shape" in reports.columns else F.lit(None).cast("string")
    return named.select("uid", "client_id", "event_name", "ts", "source", "params", shape.alias("shape"), "body", "route")


def ready_events(events: DataFrame, specs: SpecTable, app: App, seal=None, rate: float = 1.0) -> DataFrame:
    """Stateless half of P1: validated reports with bodies that lack the stream id only."""
    checked = validate_documents(events, specs, app.env, seal)
    return _ready(checked, event_body(app, rate=f"{rate!r}D", stream_id="''"))


def ready_schemas(reports: DataFrame, app: App, rate: float = 1.0) -> DataFrame:
    """Stateless half of P2: raw reports, which only tell what codegen reported, and ready-made schemas.

    Rows of source ``schema`` have ``schema_json`` and no ``props``; only they have a body.
    """
    documented = extract_document(reports, out="_extracted")
    asked = F.col("source") == "schema"
    shown = documented.withColumn("schema_json", F.when(asked, F.col("schema_json")).otherwise(F.col("_extracted")))
    shown = shown.withColumns({"shape": schema_fingerprint(F.col("schema_json")), "route": F.lit("batch")})
    for name, kind in (("event_id", "string"), ("event_hash", "string"), ("metadata", "struct<branchId:string>")):
        shown = shown.withColumn(name, F.lit(None).cast(kind))
    body = event_body(app, document="schema_json", rate=f"{rate!r}D", stream_id="''")
    return _ready(shown, F.when(asked, body))


def ready_production(events: DataFrame, app: App, rate: float = 1.0) -> DataFrame:
    """Stateless half of P4: extraction only; the stream id stays empty."""
    documented = extract_document(events).withColumn("metadata", F.lit(None).cast("struct<branchId:string>"))
    body = event_body(app, rate=f"{rate!r}D", stream_id="''")
    plain = documented.withColumns({"body": body, "route": F.lit("batch"), "source": F.lit("manual")})
    nothing = F.lit(None).cast("string")
    return plain.select("uid", "client_id", "event_name", "ts", "source", nothing.alias("params"), nothing.alias("shape"), "body", "route")


# ------------------------------------------------------------------ requests


def request_stream(ready: DataFrame, size: int = BATCH_SIZE, seconds: int = FLUSH_SECONDS, rate: float = 1.0, whole: bool = True) -> DataFrame:
    """batch_id, n_events, request, gzip of a stream of ready reports with a watermark on ``ts``.

    ``whole`` drops doubles and names identities (P1, P2); without it reports are queued as they
    are (P4).  Rows behind a client's last flush wait for the next arrival.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    data = F.to_json(F.array(*[c.cast("string") for c in (F.unix_micros("ts"), *map(F.col, ("event_name", "source", "params", "shape", "body", "route")))]))
    beside = F.col("client_id").isNull() & (F.col("route") == "immediate")
    queued = _stateful(
        ready.filter(~F.coalesce(beside, F.lit(False))), ["client_id"], data, _Requests(size, seconds, whole),
        "route string, batch_id string, n_events int, request string, gzip boolean",
    )
    queued = queued.filter((F.col("route") == "immediate") | ~(sampling_draw(F.col("batch_id")) > rate)).drop("route")
    # the text stands once in a body: inside JSON strings its quotes would be escaped
    named = F.replace("body", F.lit(_NO_STREAM), F.lit(f'{_NO_STREAM[:-1]}{UNKNOWN}"')) if whole else F.col("body")
    single = ready.filter(beside & F.col("body").isNotNull()).select(
        F.concat(F.lit("event|"), "uid").alias("batch_id"), F.lit(1).alias("n_events"), F.concat(F.lit("["), named, F.lit("]")).alias("request")
    )
    return queued.unionByName(single.withColumn("gzip", F.length("request") >= GZIP_MIN_LENGTH))


def write_requests(requests: DataFrame, path: str) -> DataStreamWriter:
    """Requests as bodies, each micro-batch once; start it with a checkpoint location and a trigger."""
    return requests.writeStream.foreachBatch(lambda batch, batch_id: write_bodies(batch, path, f"stream-{batch_id:012d}"))
