"""Envelopes: the JSON bodies that leave the pipeline (H1, H2), and their batches (A5)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.planning import settle
from plumbline.functions.values import literal, number_text, quoted
from plumbline.sources.commit import write_once

# fixed value: shorter request bodies are sent uncompressed
GZIP_MIN_LENGTH = 1024


@dataclass(frozen=True)
class App:
    """Who sends: the constant part of every body."""

    api_key: str = "api-key"
    name: str = "app"
    version: str = "1.0.0"
    lib_version: str = "1.0.0"
    env: str = "dev"
    platform: str = "web"
    public_key: str | None = None
    # name of the flag that marks a report from generated code
    codegen_flag: str = "codegenFunction"


def message_id(uid: Column) -> Column:
    """Version 4 UUID derived from the row, so that a retried task sends the same id."""
    digest = F.sha2(F.concat(F.lit("message|"), uid), 256)
    part = lambda start, length: F.substring(digest, start, length)
    return F.concat_ws(
        "-", part(1, 8), part(9, 4), F.concat(F.lit("4"), part(14, 3)), F.concat(F.lit("a"), part(18, 3)), part(21, 12)
    )


def iso_utc(ts: Column) -> Column:
    """Instant as ISO text with milliseconds, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _field(name: str, json: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), json)


def _text(name: str, value: str) -> Column:
    """Text member; ``value`` is SQL."""
    return F.expr(f"""concat('"{name}":', coalesce({quoted(value)}, 'null'))""")


def base_fields(app: App, rate: str, stream_id: str) -> list[Column]:
    """Fields shared by all bodies, in wire order (H1)."""
    fields = [
        _text("apiKey", literal(app.api_key)),
        _text("appName", literal(app.name)),
        _text("appVersion", literal(app.version)),
        _text("libVersion", literal(app.lib_version)),
        _text("env", literal(app.env)),
        _text("libPlatform", literal(app.platform)),
        _string("messageId", message_id(F.col("uid"))),
        _text("trackingId", "''"),
        _string("createdAt", iso_utc(F.col("ts"))),
        _text("sessionId", "''"),
        _text("streamId", stream_id),
        _field("samplingRate", F.expr(number_text(rate))),
    ]
    if app.public_key:
        fields.append(_text("publicEncryptionKey", literal(app.public_key)))
    return fields


def _string(name: str, value: Column) -> Column:
    """Text member of a value that needs no escapes."""
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _object(fields: list[Column]) -> Column:
    # concat_ws leaves out NULL fields
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def session_body(app: App, rate: str = "1D", stream_id: str = "stream_id") -> Column:
    """Body of a session start; ``rate`` and ``stream_id`` are SQL."""
    return _object(base_fields(app, rate, stream_id) + [_text("type", "'sessionStarted'")])


def event_body(app: App, document: str = "document", rate: str = "1D", stream_id: str = "stream_id") -> Column:
    """Body of an event (H2).

    The event id and hash are always present, as null for a manual report; the
    specification's metadata and branch only after a validation.
    """
    coded = F.col("event_id").isNotNull()
    fields = base_fields(app, rate, stream_id)
    fields += [
        _text("type", "'event'"),
        _text("eventName", "event_name"),
        _field("eventProperties", F.col(document)),
        _field(app.codegen_flag, coded.cast("string")),
        _text("eventId", "event_id"),
        _text("eventHash", "CASE WHEN event_id IS NOT NULL THEN event_hash END"),
        F.when(F.col("metadata").isNotNull(), _field("eventSpecMetadata", F.to_json("metadata"))),
        F.when(
            F.col("metadata.branchId") != "", _text("validatedBranchId", "metadata.branchId")
        ),
    ]
    return _object(fields)


def encode_batches(rows: DataFrame, batch: str = "batch_id", body: str = "body", order: list[str] = ("ts", "uid")) -> DataFrame:
    """One JSON array per batch, in order, with the flag that it is to be compressed (A5).

    A batch never exceeds the queue limit, so neither does its list.
    """
    return (
        rows.groupBy(batch)
        .agg(F.array_sort(F.collect_list(F.struct(*order, F.col(body).alias("_body")))).alias("_rows"))
        .select(
            batch,
            F.size("_rows").alias("n_events"),
            F.concat(F.lit("["), F.array_join(F.col("_rows._body"), ","), F.lit("]")).alias("request"),
        )
        .withColumn("gzip", F.length("request") >= GZIP_MIN_LENGTH)
    )


def write_bodies(requests: DataFrame, path: str, batch: str | None = None) -> None:
    """Write one request per line: long ones gzipped under ``gzip``, the rest under ``plain``.

    With the name of a ``batch`` both go to folders of that name, once: a job or micro-batch that
    runs again under the same name writes nothing.  Without one they are appended.
    """
    kept = settle(requests)
    for folder, rows, compression in (("gzip", kept.filter("gzip"), "gzip"), ("plain", kept.filter("not gzip"), "none")):
        if batch is None:
            rows.select("request").write.mode("append").option("compression", compression).text(f"{path}/{folder}")
        else:
            write_once(rows.select("request"), f"{path}/{folder}", batch, lambda df, to, c=compression: df.write.mode("overwrite").option("compression", c).text(to))
