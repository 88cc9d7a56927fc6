"""Whole inspections of a stream (P1, P2): deduplication and identity in one keyed state, then the stateless middle.

Rows keep all their columns, as JSON text in the state.  The key is the client, so a row
without one is no one's double and goes out as ``unknown``; those rows share one state.
"""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import WINDOW_MS, params_fingerprint, schema_fingerprint
from plumbline.operators.envelope import App, event_body
from plumbline.operators.extract import extract_document
from plumbline.operators.identity import IDLE_MS, MAX_AGE_MS, UNKNOWN, stream_uuid
from plumbline.plans.inspect import validate_documents
from plumbline.sources.specs import SpecTable
from plumbline.streaming.stateful import _InOrder, _stateful

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Inspect(_InOrder):
    """The two deduplication rules per event name, and the identity in force over what is kept."""

    columns = ["client_id", "payload", "created"]

    def replay(self, key, rows, memory):
        pending, created, last = memory or ({}, None, None)
        out = []
        for ms, _, data in rows:
            row = json.loads(data)
            name, source = row["event_name"], row["source"]
            # of other names, what is too old for the window goes as well
            pending = {n: live for n, of in pending.items() if (live := [p for p in of if ms - p[0] <= WINDOW_MS])}
            live = pending.get(name, [])
            if source == "schema":
                hit = next((i for i, p in enumerate(live) if p[1] == "codegen" and p[3] == row["shape"]), None)
                double = hit is not None
                if double:
                    live.pop(hit)
            else:
                double = any(p[1] != source and p[2] == row["params"] for p in live)
                if double:
                    live = []
                else:
                    live.append((ms, source, row["params"], row.get("shape")))
            pending[name] = live
            if double:
                continue
            if row["identified"]:
                if created is None or (ms - created > MAX_AGE_MS and ms - last > IDLE_MS):
                    created = ms
                last = ms
            out.append((key[0], row["payload"], created))
        return out, (pending, created, last)

    def end_of(self, memory):
        pending, created, last = memory
        ends = [p[0] + WINDOW_MS for of in pending.values() for p in of]
        if created is not None:
            ends.append(max(created + MAX_AGE_MS, last + IDLE_MS))
        return max(ends, default=0)


def _kept(events: DataFrame, identified) -> DataFrame:
    """Reports that double nothing, with ``stream_id``; ``identified`` rows count for identities.

    ``events`` carry a watermark on ``ts``.
    """
    payload = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    state = F.struct(
        "event_name",
        "source",
        F.when(F.col("source") != "schema", params_fingerprint(F.col("props"))).alias("params"),
        (F.col("shape") if "shape" in events.columns else F.lit(None).cast("string")).alias("shape"),
        identified.alias("identified"),
        payload.alias("payload"),
    )
    replayed = _stateful(events, ["client_id"], F.to_json(state), _Inspect(), "client_id string, payload string, created long")
    known = F.when(F.col("client_id").isNotNull() & F.col("created").isNotNull(), stream_uuid(F.col("client_id"), F.col("created")))
    opened = replayed.select(F.from_json("payload", events.schema).alias("row"), F.coalesce(known, F.lit(UNKNOWN)).alias("stream_id"))
    return opened.select("row.*", "stream_id")


def inspect_stream(events: DataFrame, specs: SpecTable, app: App, seal=None, rate: float = 1.0) -> DataFrame:
    """P1 on a stream: what ``inspect_events`` gives for a table."""
    checked = validate_documents(_kept(events, F.lit(True)), specs, app.env, seal)
    return checked.withColumn("body", event_body(app, rate=f"{rate!r}D"))


def inspect_schemas_stream(reports: DataFrame, app: App) -> DataFrame:
    """P2 on a stream: bodies of ready-made schemas that codegen did not just report.

    ``reports`` mixes raw reports with rows of source ``schema`` that have ``schema_json`` and no ``props``.
    """
    documented = extract_document(reports, out="_extracted")
    shown = documented.withColumn("schema_json", F.when(F.col("source") == "schema", F.col("schema_json")).otherwise(F.col("_extracted")))
    shaped = shown.drop("_extracted").withColumn("shape", schema_fingerprint(F.col("schema_json")))
    kept = _kept(shaped, F.col("source") == "schema").filter("source = 'schema'")
    for name, kind in (("event_id", "string"), ("event_hash", "string"), ("metadata", "struct<branchId:string>")):
        kept = kept.withColumn(name, F.lit(None).cast(kind))
    return kept.withColumn("body", event_body(app, document="schema_json"))
