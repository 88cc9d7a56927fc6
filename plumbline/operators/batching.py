"""Batches, retention, sampling and routing of the outgoing queue."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.planning import settle
from plumbline.operators.ordered import bucket_of, carry_last

# fixed values: defaults of the queue
BATCH_SIZE = 30
FLUSH_SECONDS = 30
QUEUE_LIMIT = 1000

_BLOCK_FLUSHES = 20
#: blocks, or groups of them, that are put together in one step
_FAN = 64
_ROW = "struct<ms:bigint,uid:string,copy:int>"
_STATE = f"struct<n:int,flushed:{_ROW}>"
_HOUR_MS = 3_600_000
#: a row of the queue: rows without a client or an id have a key as well, and repeated ids are told apart
_KEY = ["_client", "_ms", "_uid", "_copy"]


def _keyed(events: DataFrame) -> DataFrame:
    """Add ``_client``, ``_ms``, ``_uid`` and ``_copy``; none is NULL, and together they are unique.

    Only where an id names several rows are whole rows moved to number them.
    """
    mark = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = events.withColumns({"_client": mark("client_id"), "_ms": F.unix_millis("ts"), "_uid": mark("uid")})
    # an id names one row or few; rows without one are told apart inside their millisecond
    same = ["_client", "_uid", F.when(F.col("_uid") == "", F.col("_ms"))]
    if rows.groupBy(*same).count().filter("count > 1").isEmpty():
        return rows.withColumn("_copy", F.lit(1))
    return rows.withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy("_ms")))


def _advance(n: Column, flushed_ms: Column, ms: Column, size: int, wait_ms: int) -> Column:
    """Does the arrival that makes ``n`` waiting rows flush the queue?"""
    return (n % size == 0) | (ms - flushed_ms >= wait_ms)


def _run(rows: Column, begin: Column, size: int, wait_ms: int) -> Column:
    """Queue state after ``rows``."""

    def step(acc: Column, row: Column) -> Column:
        n = acc["n"] + 1
        flush = _advance(n, acc["flushed"]["ms"], row["ms"], size, wait_ms)
        return F.struct(
            F.when(flush, 0).otherwise(n).cast("int").alias("n"),
            F.when(flush, row).otherwise(acc["flushed"]).alias("flushed"),
        )

    return F.aggregate(rows, begin.cast(_STATE), step)


def _trace(size: int, wait_ms: int):
    """Each row of a block with the flush before it and whether it flushes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, begin = batch.column("rows"), batch.column("begin")
            offsets = rows.offsets.to_pylist()
            fields = [rows.values.field(i).to_pylist() for i in range(3)]
            out: list[list] = [[] for _ in range(8)]
            for block, client in enumerate(batch.column("_client").to_pylist()):
                state = begin[block].as_py()
                n, last = state["n"], state["flushed"]
                after = (last["ms"], last["uid"], last["copy"])
                for i in range(offsets[block], offsets[block + 1]):
                    row = tuple(f[i] for f in fields)
                    n += 1
                    flush = n % size == 0 or row[0] - after[0] >= wait_ms
                    for column, value in zip(out, (client, *row, *after, flush), strict=True):
                        column.append(value)
                    if flush:
                        n, after = 0, row
            types = [pa.string(), *[pa.int64(), pa.string(), pa.int32()] * 2, pa.bool_()]
            columns = [pa.array(values, t) for values, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[*_KEY, "_after_ms", "_after", "_after_copy", "flush"])

    return run


def _entries(steps: DataFrame) -> DataFrame:
    """_client, stretch, block (from 0 on), entry from ``exits``: for each way to enter a block, the way to enter the next one.

    ``_FAN`` neighbours become one step of the level above, until a stretch is
    one row; its entry is known, and each level hands down those of the level below.
    """
    owner = ["_client", "stretch"]
    children = lambda level: level.groupBy(*owner, F.floor(F.col("block") / _FAN).cast("long").alias("above")).agg(
        F.array_sort(F.collect_list(F.struct("block", "exits"))).alias("children")
    )
    through = lambda first, step: F.transform(first, lambda i: F.get(step, i))
    levels = [steps]
    while not levels[-1].groupBy(*owner).count().filter("count > 1").isEmpty():
        joined = F.aggregate(
            F.slice(F.col("children"), 2, _FAN), F.get(F.col("children"), F.lit(0))["exits"], lambda all_, child: through(all_, child["exits"])
        )
        levels.append(settle(children(levels[-1]).select(*owner, F.col("above").alias("block"), joined.alias("exits"))))
    entries = levels[-1].select(*owner, "block", F.lit(0).alias("entry"))
    kind = "struct<at:int,out:array<struct<block:bigint,entry:int>>>"

    def walk(acc: Column, child: Column) -> Column:
        out = F.concat(acc["out"], F.array(F.struct(child["block"].alias("block"), acc["at"].alias("entry"))))
        return F.struct(F.get(child["exits"], acc["at"]).alias("at"), out.alias("out"))

    for level in reversed(levels[:-1]):
        start = F.struct(F.col("entry").alias("at"), F.array().alias("out")).cast(kind)
        down = children(level).join(entries.withColumnRenamed("block", "above"), [*owner, "above"])
        entries = down.select(*owner, F.inline(F.aggregate("children", start, walk, lambda acc: acc["out"])))
    return entries


def assign_batches(events: DataFrame, size: int = BATCH_SIZE, seconds: int = FLUSH_SECONDS) -> DataFrame:
    """Add ``batch_id`` and ``flush``: the queue is sent at every ``size`` rows or ``seconds`` after the last flush (G1).

    A batch is named after its client and the flush before it.  Rows behind a
    client's last flush are still waiting: their batch has no flushing row.  Rows
    without a client share the queue ``unknown``; rows that repeat an id are rows of
    their own, the second one with ``#2`` behind its id, and so on.

    The replay is exact and split in time.  An arrival after a silence of
    ``seconds`` always flushes, so what follows it starts from a known state.
    Longer busy stretches are cut into blocks: each block works out its exit for
    every state it could be entered in (at most ``size``).  Exits of neighbours are
    put together as a tree, and the real entries are handed down it, so a client
    that never pauses is no single task either.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    wait_ms = seconds * 1000
    width_ms = wait_ms * _BLOCK_FLUSHES
    events = _keyed(events)
    rows = events.select("_client", F.struct(F.col("_ms").alias("ms"), F.col("_uid").alias("uid"), F.col("_copy").alias("copy")).alias("row"))
    rows = rows.withColumn("ms", F.col("row.ms"))

    # a bucket as wide as the wait has no silence inside: look between buckets only
    spans = (
        rows.groupBy("_client", bucket_of(F.col("ms"), wait_ms).alias("tick"))
        .agg(F.min("row").alias("head"), F.max("ms").alias("last_ms"))
    )
    by_tick = Window.partitionBy("_client").orderBy("tick")
    before = F.lag("last_ms").over(by_tick)
    spans = spans.withColumns(
        {
            "breaker": F.coalesce(F.col("head.ms") - before >= wait_ms, F.lit(False)),
            "opening": before.isNull(),
            "before_ms": before,
        }
    )
    # state that holds right after a breaker, or before a client's first row
    nothing = F.struct(F.col("head.ms"), F.lit(None).cast("string").alias("uid"), F.lit(1).alias("copy"))
    known = F.when(F.col("breaker"), F.col("head")).when(F.col("opening"), nothing)
    spans = spans.withColumn("known", known.cast(_ROW))
    running = by_tick.rowsBetween(Window.unboundedPreceding, 0)
    earlier = by_tick.rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "_client",
        "tick",
        F.when(F.col("breaker"), F.col("head")).alias("breaker_row"),
        "before_ms",
        F.last("known", ignorenulls=True).over(running).alias("stretch"),
        F.last("known", ignorenulls=True).over(earlier).alias("stretch_before"),
    )

    # a breaker closes the stretch before it, in the block that the silence began in
    breaks = F.coalesce(F.col("row") == F.col("breaker_row"), F.lit(False))
    placed = (
        rows.withColumn("tick", bucket_of(F.col("ms"), wait_ms))
        .join(spans, ["_client", "tick"])
        .withColumn("block", bucket_of(F.when(breaks, F.col("before_ms")).otherwise(F.col("ms")), width_ms))
        .withColumn("stretch", F.when(breaks, F.col("stretch_before")).otherwise(F.col("stretch")))
    )
    blocks = placed.groupBy("_client", "stretch", "block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    # a stretch has rows in each of its blocks, as none of its silences is as long as a block
    blocks = settle(blocks)
    place = ["_client", "stretch", "block"]
    spans = blocks.groupBy("_client", "stretch").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    longest = spans.agg(F.max(F.col("last") - F.col("first"))).first()[0] or 0
    begin = F.struct(F.lit(0).alias("n"), F.col("stretch").alias("flushed")).cast(_STATE)
    if longest:
        # the rows that can be the last flush before the next block, newest first; before the
        # first flush of a stretch that is the one that began it
        marked = blocks.join(spans, ["_client", "stretch"])
        opening = F.when(F.col("block") == F.col("first"), F.array("stretch")).otherwise(F.array().cast(f"array<{_ROW}>"))
        recent = F.slice(F.concat(F.reverse("rows"), opening), 1, size)
        before = marked.filter("block < last").select("_client", "stretch", (F.col("block") + 1).alias("block"), recent.alias("tail"))
        blocks = marked.join(before, place, "left")
        # entry n: the last flush was n rows before the block
        entered = F.transform(F.col("tail"), lambda flushed, n: F.struct(n.cast("int").alias("n"), flushed.alias("flushed")))
        states = F.coalesce(entered.cast(f"array<{_STATE}>"), F.array(begin))
        exits = F.transform(states, lambda state: _run(F.col("rows"), state, size, wait_ms)["n"])
        steps = settle(blocks.filter("first < last").select(*place, exits.alias("exits")))
        blocks = blocks.join(_entries(settle(steps)), place, "left")
        known = F.struct(F.col("entry").alias("n"), F.get("tail", F.col("entry")).alias("flushed")).cast(_STATE)
        begin = F.when(F.col("tail").isNotNull(), known).otherwise(begin)
    traced = (
        blocks.select("_client", "rows", begin.alias("begin"))
        .mapInArrow(_trace(size, wait_ms), "_client string, _ms long, _uid string, _copy int, _after_ms long, _after string, _after_copy int, flush boolean")
    )
    # "=" stands before an id that is there
    after = F.when(F.col("_after") == "", F.concat(F.lit("null@"), F.col("_after_ms").cast("string"))).otherwise(F.substr("_after", F.lit(2)))
    after = F.concat(after, F.when(F.col("_after_copy") > 1, F.concat(F.lit("#"), F.col("_after_copy").cast("string"))).otherwise(""))
    client = F.coalesce(F.col("client_id"), F.lit("unknown"))
    named = events.join(traced, _KEY).withColumn("batch_id", F.concat_ws("|", client, F.coalesce(after, F.lit("start"))))
    return named.select(*[c for c in events.columns if c not in _KEY], "batch_id", "flush")


def _ranked(events: DataFrame, newest_first: bool) -> DataFrame:
    """Add ``_rank`` of each row within its client, without a task that holds a client.

    Rows are numbered inside each hour; the rows of the hours before are a running sum of counts.
    """
    turn = (lambda c: F.desc(c)) if newest_first else (lambda c: F.asc(c))
    rows = _keyed(events).withColumn("_hour", bucket_of(F.col("_ms"), _HOUR_MS))
    counts = rows.groupBy("_client", "_hour").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_client").orderBy(turn("_hour")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_client", "_hour", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_client", "_hour").orderBy(turn("ts"), turn("_uid"), turn("_copy")))
    ranked = rows.join(before, ["_client", "_hour"]).withColumn("_rank", F.col("_before") + within)
    return ranked.select(*events.columns, "_rank")


def count_batches(events: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch_no`` by arrival count alone (G1 without the time trigger)."""
    ranked = _ranked(events, newest_first=False)
    return ranked.withColumn("batch_no", F.floor((F.col("_rank") - 1) / size).cast("long")).drop("_rank")


def retain_latest(events: DataFrame, n: int = QUEUE_LIMIT) -> DataFrame:
    """Newest ``n`` rows per client (G2), whatever ``n``; rows without a client are one queue."""
    return _ranked(events, newest_first=True).filter(F.col("_rank") <= n).drop("_rank")


def drop_null_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Null entries leave the queue; a batch without rows is not sent."""
    return df.filter(F.col(body).isNotNull())


def sampling_draw(batch_id: Column, seed: str = "") -> Column:
    """Reproducible draw in [0, 1] per batch."""
    digest = F.md5(F.concat(batch_id, F.lit(seed)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def sample_batches(df: DataFrame, rate: Column, batch: str = "batch_id", seed: str = "") -> DataFrame:
    """Drop whole batches whose draw exceeds the rate."""
    return df.filter(~(sampling_draw(F.col(batch), seed) > rate))


def adopt_sampling_rate(batches: DataFrame, rates: DataFrame, initial: float = 1.0) -> DataFrame:
    """Add the latest valid ``rate`` a client was told before each batch.

    ``batches`` has ``client_id``, ``sent_at`` and a unique ``batch_id``; ``rates`` has
    ``client_id``, ``ts`` and ``rate``.  A rate told at the instant of a batch is in force.
    """
    told = rates.filter(F.col("rate").isNotNull() & ~F.isnan("rate")).select(
        "client_id", F.unix_micros("ts").alias("_at"), F.lit(0).alias("_kind"), F.col("rate").alias("_rate")
    )
    asked = batches.withColumns(
        {"_at": F.unix_micros("sent_at"), "_kind": F.lit(1), "_rate": F.lit(None).cast("double")}
    )
    both = asked.unionByName(told, allowMissingColumns=True)
    carried = carry_last(
        both, ["client_id"], "_at", ["_at", "_kind", "batch_id"], "_rate", "rate", width_ms=3_600_000_000
    )
    return (
        carried.filter("_kind = 1").withColumn("rate", F.coalesce("rate", F.lit(initial))).drop("_at", "_kind", "_rate")
    )


def route(df: DataFrame, env: str = "dev", plan: str = "plan") -> DataFrame:
    """Add ``route``: validated events go out at once, all others are batched."""
    validated = F.lit(False) if env == "prod" else F.col(plan).isNotNull()
    return df.withColumn("route", F.when(validated, "immediate").otherwise("batch"))


def requeue_failed(rows: DataFrame, acks: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Next queue: newer arrivals, then the rows of unacknowledged batches.

    A failed immediate send is queued without metadata and branch, also inside a ``body``
    that was put together before.
    """
    failed = rows.join(acks.select("batch_id").distinct(), "batch_id", "left_anti")
    for name in ("metadata", "validated_branch_id"):
        if name in failed.columns:
            failed = failed.withColumn(name, F.lit(None).cast(dict(failed.dtypes)[name]))
    if "body" in failed.columns:
        # the last fields of a body; inside JSON text the quotes of the name would be escaped
        failed = failed.withColumn("body", F.regexp_replace("body", r'(?s),"eventSpecMetadata":\{.*$', "}"))
    queued = arrivals.withColumn("queue_part", F.lit(0)).unionByName(
        failed.withColumn("queue_part", F.lit(1)), allowMissingColumns=True
    )
    return queued
