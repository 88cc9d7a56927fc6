"""Anonymous stream identities and session starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import bucket_of

# fixed values: an identity is renewed when it is both older and idle for longer than these
MAX_AGE_MS = 4 * 60 * 60 * 1000
IDLE_MS = 2 * 60 * 60 * 1000
UNKNOWN = "unknown"
_HOUR_MS = 3_600_000


def stream_uuid(client: Column, created_ms: Column) -> Column:
    """Deterministic identifier in UUID form."""
    digest = F.sha2(F.concat_ws("|", client, created_ms.cast("string")), 256)
    part = lambda start, length: F.substring(digest, start, length)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def identity_hours(events: DataFrame) -> DataFrame:
    """Creation time of the identity in force, per client and active hour.

    Two events of one hour are never idle for longer than the limit, so hourly
    minima and maxima (a partial aggregate) hold all that the rule needs.
    """
    ms = F.unix_millis("ts")
    hours = (
        events.filter(F.col("client_id").isNotNull())
        .groupBy("client_id", bucket_of(ms, _HOUR_MS).alias("hour"))
        .agg(F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"))
    )
    by_hour = Window.partitionBy("client_id").orderBy("hour")
    idle = F.col("first_ms") - F.lag("last_ms").over(by_hour)
    hours = hours.withColumn("start", F.when(idle.isNull() | (idle > IDLE_MS), F.col("first_ms")))

    state = "struct<created:bigint,out:array<struct<start:bigint,created:bigint>>>"
    begin = F.struct(F.lit(None).cast("long").alias("created"), F.array().alias("out")).cast(state)

    def step(acc: Column, start: Column) -> Column:
        renew = acc["created"].isNull() | (start - acc["created"] > MAX_AGE_MS)
        created = F.when(renew, start).otherwise(acc["created"])
        entry = F.struct(start.alias("start"), created.alias("created"))
        return F.struct(created.alias("created"), F.concat(acc["out"], F.array(entry)).alias("out"))

    created = (
        hours.filter(F.col("start").isNotNull())
        .groupBy("client_id")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"))
        .select("client_id", F.inline_outer(F.aggregate("starts", begin, step, lambda acc: acc["out"])))
    )
    running = by_hour.rowsBetween(Window.unboundedPreceding, 0)
    return (
        hours.withColumn("start", F.last("start", ignorenulls=True).over(running))
        .join(created, ["client_id", "start"])
        .select("client_id", "hour", "created")
    )


def assign_stream_id(events: DataFrame) -> DataFrame:
    """Add ``stream_id`` (F1); a row without a client gets ``unknown``."""
    keyed = events.withColumn("hour", bucket_of(F.unix_millis("ts"), _HOUR_MS))
    joined = keyed.join(identity_hours(events), ["client_id", "hour"], "left")
    known = F.when(F.col("created").isNotNull(), stream_uuid(F.col("client_id"), F.col("created")))
    return joined.withColumn("stream_id", F.coalesce(known, F.lit(UNKNOWN))).drop("hour", "created")


def backfill_unknown_stream(df: DataFrame, batch: str = "batch_id", order: list[str] = ("ts", "uid"), current: str = "current_stream_id") -> DataFrame:
    """Replace ``unknown`` by the last known id of the batch, else the client's current id (F2).

    A batch is bounded by the queue limit, so its window is too.
    """
    known = F.when(F.col("stream_id") != UNKNOWN, F.col("stream_id"))
    whole = (
        Window.partitionBy(batch)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return df.withColumn("_known", F.last(known, ignorenulls=True).over(whole)).withColumn(
        "stream_id",
        F.when(F.col("stream_id") == UNKNOWN, F.coalesce("_known", current)).otherwise(F.col("stream_id")),
    ).drop("_known")


def session_started_rows(events: DataFrame) -> DataFrame:
    """One ``sessionStarted`` row per stream id, at its first event."""
    first = F.min_by(F.struct("client_id", "uid", "ts"), F.struct("ts", "uid")).alias("f")
    return (
        events.filter(F.col("stream_id") != UNKNOWN)
        .groupBy("stream_id")
        .agg(first)
        .select("stream_id", "f.client_id", "f.uid", "f.ts", F.lit("sessionStarted").alias("type"))
    )
