"""Ordered look-back without ever holding one key's rows in one task.

A window over a hot key would put all its rows into one task.  Two exact ways
around that, both on fixed time buckets:

* ``with_context``: the look-back has a fixed horizon.  Rows near the end of a
  bucket are copied into the next one, so each bucket sees all it needs.
* ``carry_last``: the look-back is unlimited.  The last value of each bucket is
  found with a partial aggregate, carried over the (few) buckets of a key, and
  joined back for the rows that find nothing in their own bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_of(ms: Column, width_ms: int) -> Column:
    return F.floor(ms / F.lit(width_ms)).cast("long")


def with_context(df: DataFrame, ms: str, horizon_ms: int, width_ms: int, both_sides: bool = False) -> DataFrame:
    """Add ``_bucket`` and ``_context``; context rows are copies that only serve as look-back.

    ``both_sides`` also copies rows into the bucket before, for look-ahead.
    """
    own = bucket_of(F.col(ms), width_ms)
    after = bucket_of(F.col(ms) + horizon_ms, width_ms)
    places = [own, F.when(after > own, after)]
    if both_sides:
        before = bucket_of(F.col(ms) - horizon_ms, width_ms)
        places.append(F.when(before < own, before))
    df = df.select("*", F.explode_outer(F.array_compact(F.array(*places))).alias("_bucket"))
    return df.withColumn("_context", F.col("_bucket") != own)


def carry_last(
    df: DataFrame,
    keys: list[str],
    ms: str,
    order: list[str],
    value: str,
    out: str,
    width_ms: int = 3_600_000,
    backward: bool = False,
    include_current: bool = True,
) -> DataFrame:
    """Last non-null ``value`` of the key up to each row; ``backward`` looks ahead instead.

    ``order`` breaks the order within a key completely; its first column is ``ms``.
    """
    direction = (lambda c: F.col(c).desc()) if backward else (lambda c: F.col(c).asc())
    df = df.withColumn("_bucket", bucket_of(F.col(ms), width_ms))
    frame = Window.partitionBy(*keys, "_bucket").orderBy(*[direction(c) for c in order])
    frame = frame.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    local = df.withColumn("_local", F.last(value, ignorenulls=True).over(frame))

    # ordering by NULL takes rows without a value out of the running
    pick = F.min_by if backward else F.max_by
    rank = F.when(F.col(value).isNotNull(), F.struct(*order))
    buckets = df.groupBy(*keys, "_bucket").agg(pick(value, rank).alias("_end"))
    across = Window.partitionBy(*keys).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*keys, "_bucket", F.last("_end", ignorenulls=True).over(across).alias("_carried"))
    joined = local.join(carried, [*keys, "_bucket"], "left")
    return joined.withColumn(out, F.coalesce("_local", "_carried")).drop("_bucket", "_local", "_carried")
