"""Specification lookup: joins by key, by freshness and by branch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.ordered import bucket_of, with_context
from plumbline.sources.specs import SpecTable


def lookup_spec(events: DataFrame, specs: SpecTable, env: str = "dev") -> DataFrame:
    """Attach ``metadata``, ``all_ids`` and ``plan`` by key.

    Without a specification they are NULL, and so they are for all of ``prod``.
    A table measured as small is broadcast.  A larger one is joined by shuffle,
    where adaptive execution splits the partitions of a hot key.
    """
    if env == "prod":
        kinds = dict(specs.df.dtypes)
        nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in ("metadata", "all_ids", "plan")]
        return events.select("*", *nothing)
    side = specs.df.select(*specs.keys, "metadata", "all_ids", "plan")
    return events.join(F.broadcast(side) if specs.small else side, specs.keys, "left")


def spec_keys_needed(events: DataFrame, loaded: DataFrame, keys: list[str], schemas: DataFrame | None = None) -> DataFrame:
    """Distinct keys to request that are not loaded yet.

    Pre-extracted schemas are not validated but do warm the table (D5).
    """
    wanted = events.select(*keys)
    if schemas is not None:
        wanted = wanted.unionByName(schemas.select(*keys))
    return wanted.distinct().join(loaded.select(*keys), keys, "left_anti")


def branch_epochs(fetches: DataFrame, stream: list[str]) -> DataFrame:
    """Add ``branch_changed``, ``epoch_ms`` and ``invalid_ms`` to specification fetches.

    A fetch of another branch than the stream's current one makes all earlier
    specifications invalid.  ``epoch_ms`` is when the fetch's branch became
    current, ``invalid_ms`` when the next change takes it out of use.  A fetch
    that found nothing (NULL ``branch_id``) changes nothing.
    """
    # hours of a stream: what is known inside one, then what enters it, then both together
    keys, hour = [*stream, "_bucket"], 3_600_000
    ms, branch = F.col("fetched_ms"), F.col("branch_id")
    upwards, downwards = ["fetched_ms", "fetch_id"], [F.desc("fetched_ms"), F.desc("fetch_id")]
    inside = Window.partitionBy(*keys).orderBy(*upwards)
    first, one_before = Window.unboundedPreceding, -1
    rows = fetches.withColumn("fetched_ms", F.unix_millis("fetched_at")).withColumn("_bucket", bucket_of(ms, hour))
    rows = rows.withColumn("_prev", F.last("branch_id", True).over(inside.rowsBetween(first, one_before)))

    rank = F.when(branch.isNotNull(), F.struct(*upwards))
    within = F.when(branch != F.col("_prev"), ms)
    hours = rows.groupBy(*keys).agg(
        F.min_by(F.struct("fetched_ms", "branch_id"), rank).alias("_head"),
        F.max_by("branch_id", rank).alias("_last"),
        F.min(within).alias("_low"),
        F.max(within).alias("_high"),
    )
    before = Window.partitionBy(*stream).orderBy("_bucket").rowsBetween(first, one_before)
    behind = Window.partitionBy(*stream).orderBy(F.desc("_bucket")).rowsBetween(first, one_before)
    hours = hours.withColumn("_in", F.last("_last", True).over(before))
    head = F.when(F.col("_head.branch_id") != F.col("_in"), F.col("_head.fetched_ms"))
    hours = hours.withColumns({"_first": F.coalesce(head, "_low"), "_latest": F.coalesce("_high", head)}).select(
        *keys,
        "_in",
        F.last("_latest", True).over(before).alias("_epoch"),
        F.last("_first", True).over(behind).alias("_next"),
    )
    changed = F.coalesce(branch != F.coalesce("_prev", "_in"), F.lit(False))
    df = rows.join(hours, keys, "left").withColumn("branch_changed", changed).withColumn("_change", F.when(F.col("branch_changed"), ms))
    later = Window.partitionBy(*keys).orderBy(*downwards).rowsBetween(first, one_before)
    return df.withColumns(
        {
            "epoch_ms": F.coalesce(F.last("_change", True).over(inside.rowsBetween(first, 0)), "_epoch"),
            "invalid_ms": F.coalesce(F.last("_change", True).over(later), "_next"),
        }
    ).drop("_bucket", "_prev", "_in", "_epoch", "_next", "_change")


# fixed value: how long a fetched specification stays usable
FRESH_MS = 60_000


def spec_asof(events: DataFrame, snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the newest snapshot of the key that is still fresh at event time (D3).

    ``snapshots`` has the keys, ``fetched_ms``, ``fetch_id`` (which orders fetches of one
    millisecond), ``invalid_ms`` and ``spec`` (NULL for a known-absent answer).  Adds ``spec_state`` (``hit``, ``absent`` or ``miss``) and
    ``spec``.  Freshness bounds the look-back, so each minute of a key is a group.
    """
    told = snapshots.select(
        *keys,
        F.col("fetched_ms").alias("_ms"),
        F.lit(0).alias("_kind"),
        F.col("fetch_id").alias("_fetch"),
        F.struct("fetched_ms", "invalid_ms", "spec").alias("_snapshot"),
    )
    asked = events.withColumns({"_ms": F.unix_millis("ts"), "_kind": F.lit(1)})
    both = with_context(asked.unionByName(told, allowMissingColumns=True), "_ms", FRESH_MS, FRESH_MS)
    both = both.filter("_kind = 0 or not _context")
    order = Window.partitionBy(*keys, "_bucket").orderBy("_ms", "_kind", "_fetch")
    latest = F.last("_snapshot", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_found", latest).filter("_kind = 1")
    usable = (F.col("_ms") - F.col("_found.fetched_ms") <= FRESH_MS) & (
        F.col("_found.invalid_ms").isNull() | (F.col("_ms") < F.col("_found.invalid_ms"))
    )
    usable = F.coalesce(usable, F.lit(False))
    state = F.when(~usable, "miss").when(F.col("_found.spec").isNull(), "absent").otherwise("hit")
    return (
        found.withColumn("spec_state", state)
        .withColumn("spec", F.when(usable, F.col("_found.spec")))
        .drop("_ms", "_kind", "_fetch", "_snapshot", "_bucket", "_context", "_found")
    )
