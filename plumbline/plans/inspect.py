"""What a user calls: inspect events, inspect schemas, extract only, production profile.

Events are accepted ones: ``inspect_raw`` and ``sources.events.split_rejects`` take
out those whose property text is not one JSON object.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.documents import add_schema_document, drop_levels, open_levels
from plumbline.functions.planning import settle
from plumbline.operators.batching import assign_batches, drop_null_events, route, sample_batches
from plumbline.operators.dedup import dedup_events, schema_fingerprint, seen_by_codegen
from plumbline.operators.envelope import App, encode_batches, event_body
from plumbline.operators.extract import extract_document
from plumbline.operators.identity import assign_stream_id
from plumbline.operators.lookup import lookup_spec
from plumbline.operators.validate import add_results
from plumbline.sources.events import split_rejects
from plumbline.sources.specs import SpecTable


def validate_documents(events: DataFrame, specs: SpecTable, env: str = "dev", seal=None) -> DataFrame:
    """Stateless middle of an inspection, the same for tables and streams.

    Adds ``document`` (with validation ids), ``results``, ``metadata`` and ``route``.
    """
    opened = lookup_spec(open_levels(events, "props"), specs, env)
    checked = route(add_results(opened, patterns=specs.patterns), env)
    documented = add_schema_document(checked, "document", results="results", seal=seal)
    return drop_levels(documented).drop("all_ids", "plan")


def inspect_events(events: DataFrame, specs: SpecTable, app: App, seal=None, rate: float = 1.0) -> DataFrame:
    """Deduplicate, identify, extract, look up, validate, merge and wrap events.

    ``rate`` is the sampling rate in force, which bodies state and ``outgoing_requests`` applies.
    """
    kept = assign_stream_id(dedup_events(events))
    checked = validate_documents(kept, specs, app.env, seal)
    return checked.withColumn("body", event_body(app, rate=f"{rate!r}D"))


def inspect_raw(events: DataFrame, specs: SpecTable, app: App, seal=None, rate: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Inspections of the accepted events, and the rejects whose property text is not one JSON object."""
    accepted, rejects = split_rejects(events)
    return inspect_events(accepted, specs, app, seal, rate), rejects


def outgoing_requests(inspected: DataFrame, rate: float = 1.0, size: int = 30, seconds: int = 30) -> DataFrame:
    """Requests of an inspection: validated events one by one, the rest in sampled batches."""
    columns = ["uid", "client_id", "ts", "body", "route"]
    # the queue is read several times: bodies are put together once
    queue = settle(drop_null_events(inspected.select(*columns)))
    single = queue.filter("route = 'immediate'").withColumn("batch_id", F.concat(F.lit("event|"), "uid"))
    waiting = assign_batches(queue.filter("route = 'batch'"), size, seconds).drop("flush")
    sent = sample_batches(waiting, F.lit(rate))
    return encode_batches(single.unionByName(sent))


def inspect_schemas(schemas: DataFrame, events: DataFrame, app: App) -> DataFrame:
    """Wrap pre-extracted schemas that codegen did not just report (P2); nothing is validated.

    ``schemas`` has ``uid, client_id, event_name, ts, schema_json``; ``events`` the raw reports.
    """
    reported = extract_document(events, out="schema_json").select(
        "uid", "client_id", "event_name", "ts", "source", "props", "schema_json"
    )
    asked = schemas.withColumns({"source": F.lit("schema"), "props": F.lit(None).cast("string")})
    both = reported.unionByName(asked, allowMissingColumns=True)
    both = both.withColumn("shape", schema_fingerprint(F.col("schema_json")))
    kept = dedup_events(both, schema="shape").filter("source = 'schema'")
    for name, kind in (("event_id", "string"), ("event_hash", "string"), ("metadata", "struct<branchId:string>")):
        kept = kept.withColumn(name, F.lit(None).cast(kind))
    return assign_stream_id(kept).withColumn("body", event_body(app, document="schema_json"))


def extract_only(events: DataFrame, pending: DataFrame) -> DataFrame:
    """Documents, with the warning flag that codegen just reported the same properties."""
    return extract_document(seen_by_codegen(events, pending))


def production_profile(
    events: DataFrame, app: App, rate: float = 1.0, size: int = 30, seconds: int = 30
) -> DataFrame:
    """Extraction, batching and sampling only; the stream id stays empty."""
    # sampled batches first, so that each event is opened once, and only if it is sent
    queue = sample_batches(assign_batches(events, size, seconds).drop("flush"), F.lit(rate))
    documented = extract_document(queue).withColumn("metadata", F.lit(None).cast("struct<branchId:string>"))
    return encode_batches(documented.withColumn("body", event_body(app, rate=f"{rate!r}D", stream_id="''")))
