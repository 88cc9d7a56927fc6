"""Removal of double reports from parallel instrumentation paths.

Input rows carry ``uid`` (unique), ``client_id``, ``event_name``, ``ts`` and
``source``: ``manual``, ``codegen`` or ``schema`` for a pre-extracted schema.
Rows with equal ``ts`` are taken in order of ``uid``.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.planning import broadcast_if_small, settle
from plumbline.operators.ordered import carry_last, with_context

# fixed value: how long a report waits for its double
WINDOW_MS = 300
_WIDTH_MS = 60_000
# rows in front of a block from which its first entry is worked out
_RUN_UP_MS = 3_000


def params_fingerprint(props: Column) -> Column:
    """Equal for deeply equal property objects (E4): member order is ignored, element order is not."""
    canonical = F.to_json(F.try_parse_json(props))
    return F.sha2(F.coalesce(canonical, props, F.lit("null")), 256)


def schema_fingerprint(document: Column, ordered: bool = True) -> Column:
    """Equal for equal schema documents.

    Property order counts as long as ``ordered`` is set; otherwise top-level
    properties are compared as a set.
    """
    if ordered:
        return F.sha2(document, 256)
    properties = F.transform(
        F.try_variant_get(F.try_parse_json(document), "$", "array<variant>"), lambda p: F.to_json(p)
    )
    return F.sha2(F.array_join(F.array_sort(properties), ","), 256)


def _narrow(df: DataFrame, schema: str | None) -> DataFrame:
    return df.select(
        "uid",
        "client_id",
        "event_name",
        "source",
        F.unix_millis("ts").alias("ms"),
        F.when(F.col("source") != "schema", params_fingerprint(F.col("props"))).alias("params"),
        (F.col(schema) if schema else F.lit(None).cast("string")).alias("shape"),
    )


def _near(df: DataFrame, match: list[str], one: Column, other: Column) -> DataFrame:
    """Rows of one side with an equal row of the other side inside the window, before or after."""
    spread = with_context(df.filter(one | other), "ms", WINDOW_MS, _WIDTH_MS, both_sides=True)
    keys = Window.partitionBy(*match, "_bucket")
    back = keys.orderBy("ms", "uid").rowsBetween(Window.unboundedPreceding, -1)
    # looking ahead is looking back in the other order: both frames grow row by row
    ahead = keys.orderBy(F.desc("ms"), F.desc("uid")).rowsBetween(Window.unboundedPreceding, -1)
    ones, others = F.when(one, F.col("ms")), F.when(other, F.col("ms"))
    close = lambda c, sign: F.coalesce((c - F.col("ms")) * sign <= WINDOW_MS, F.lit(False))
    marked = spread.select(
        "*",
        F.last(ones, True).over(back).alias("_one_back"),
        F.last(others, True).over(back).alias("_other_back"),
        F.last(ones, True).over(ahead).alias("_one_ahead"),
        F.last(others, True).over(ahead).alias("_other_ahead"),
    )
    near_other = close(F.col("_other_back"), -1) | close(F.col("_other_ahead"), 1)
    near_one = close(F.col("_one_back"), -1) | close(F.col("_one_ahead"), 1)
    involved = marked.filter(~F.col("_context") & ((one & near_other) | (other & near_one)))
    return involved.drop("_bucket", "_context", "_one_back", "_other_back", "_one_ahead", "_other_ahead")


def _islands(rows: DataFrame) -> DataFrame:
    """Add ``island``: start of the burst, cut where a key is silent for longer than the window."""
    keys = ["client_id", "event_name"]
    spread = with_context(rows, "ms", WINDOW_MS, _WIDTH_MS)
    order = Window.partitionBy(*keys, "_bucket").orderBy("ms", "uid")
    gap = F.col("ms") - F.lag("ms").over(order)
    starts = spread.withColumn("_start", F.when(gap.isNull() | (gap > WINDOW_MS), F.col("ms")))
    own = starts.filter(~F.col("_context")).drop("_bucket", "_context")
    return carry_last(own, keys, "ms", ["ms", "uid"], "_start", "island")


def _replay_rows(rows: Iterator[tuple], pending: deque) -> list[str]:
    """Uids of the duplicates among ordered rows; ``pending`` is what they find, and then what they leave."""
    found = []
    for ms, uid, source, params, shape in rows:
        while pending and ms - pending[0][0] > WINDOW_MS:
            pending.popleft()
        if source == "schema":
            hit = next((p for p in pending if p[2] == "codegen" and p[4] == shape and shape is not None), None)
            if hit is not None:
                pending.remove(hit)
                found.append(uid)
        elif any(p[2] != source and p[3] == params for p in pending):
            pending.clear()
            found.append(uid)
        else:
            pending.append((ms, uid, source, params, shape))
    return found


_PENDING = "array<struct<ms:bigint,uid:string,source:string,params:string,shape:string>>"
_BURST = "struct<client_id:string,event_name:string,island:bigint>"
_FIELDS = ["ms", "uid", "source", "params", "shape"]


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replays blocks of bursts: what each was entered with, what it leaves, and its duplicates.

    Without an ``entry`` the rows just before the block, replayed from nothing, stand in for it.
    Blocks become Python objects one at a time: those of a batch would take many times its bytes.
    """
    entry_type = pa.list_(pa.struct([(f, pa.int64() if f == "ms" else pa.string()) for f in _FIELDS]))
    for batch in batches:
        out: dict[str, list] = {"first_ms": [], "entered": [], "left": [], "doubles": []}
        for entry, rows in zip(batch.column("entry"), batch.column("rows"), strict=True):
            entry, rows = entry.as_py(), rows.as_py()
            own = [tuple(r[f] for f in _FIELDS) for r in rows if not r["_context"]]
            first_ms = own[0][0]
            if entry is None:
                pending: deque = deque()
                _replay_rows((tuple(r[f] for f in _FIELDS) for r in rows if r["_context"]), pending)
            else:
                pending = deque(tuple(p[f] for f in _FIELDS) for p in entry)
            live = [p for p in pending if first_ms - p[0] <= WINDOW_MS]
            pending = deque(live)
            doubles = _replay_rows(iter(own), pending)
            named = lambda of: [dict(zip(_FIELDS, p, strict=True)) for p in of]
            for column, value in zip(out.values(), (first_ms, named(live), named(pending), doubles), strict=True):
                column.append(value)
        types = [pa.int64(), entry_type, entry_type, pa.list_(pa.string())]
        columns = [batch.column("burst"), batch.column("block"), *(pa.array(v, t) for v, t in zip(out.values(), types, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, names=["burst", "block", *out])


def _doubles(rows: DataFrame) -> DataFrame:
    """Uids of the duplicates of bursts, replayed block by block; ``rows`` have their ``island``.

    A block is first entered with what a short run-up leaves.  Where the block before it left
    something else it is replayed with that, until all blocks agree with the ones before them;
    as a double empties what waits, run-ups hardly ever differ.
    """
    spread = with_context(rows, "ms", _RUN_UP_MS, _WIDTH_MS).withColumn("burst", F.struct("client_id", "event_name", "island").cast(_BURST))
    blocks = (
        spread.groupBy("burst", F.col("_bucket").alias("block"))
        .agg(F.array_sort(F.collect_list(F.struct(*_FIELDS, "_context"))).alias("rows"), F.min("_context").alias("empty"))
        .filter("NOT empty")
        .drop("empty")
    )
    shape = f"burst {_BURST}, block long, first_ms long, entered {_PENDING}, left {_PENDING}, doubles array<string>"
    state = settle(blocks.withColumn("entry", F.lit(None).cast(_PENDING)).mapInArrow(_replay, shape))
    place = ["burst", "block"]
    while True:
        before = state.select("burst", (F.col("block") + 1).alias("block"), F.col("left").alias("before"))
        entry = F.filter("before", lambda p: F.col("first_ms") - p["ms"] <= WINDOW_MS)
        wrong = state.join(before, place).select(*place, "entered", entry.alias("entry")).filter("entry <> entered")
        wrong = settle(wrong.select(*place, "entry"))
        if wrong.isEmpty():
            return state.select(F.explode("doubles").alias("uid"))
        again = blocks.join(wrong, place).select("burst", "block", "rows", "entry").mapInArrow(_replay, shape)
        state = settle(state.join(wrong.select(*place), place, "left_anti").unionByName(again))


def find_duplicates(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Uids of doubled events and, given a ``schema`` fingerprint column, doubled schemas.

    Only rows with an equal counterpart in the window can match or clear
    anything, so all others are set aside before the ordered replay.
    """
    narrow = _narrow(df, schema)
    manual, codegen, shaped = (F.col("source") == s for s in ("manual", "codegen", "schema"))
    keys = ["client_id", "event_name"]
    involved = _near(narrow, keys + ["params"], manual, codegen)
    if schema:
        by_shape = _near(narrow, keys + ["shape"], codegen, shaped)
        involved = involved.unionByName(by_shape).dropDuplicates(["uid"])
    # few rows, used twice from here on
    involved = settle(involved)
    return _doubles(_islands(involved))


def dedup_events(df: DataFrame, schema: str | None = None) -> DataFrame:
    """Drop reports that double one of the other path at most 300 ms earlier."""
    doubles = broadcast_if_small(settle(find_duplicates(df, schema)))
    return df.join(doubles, "uid", "left_anti")


def seen_by_codegen(checks: DataFrame, events: DataFrame) -> DataFrame:
    """Flag ``checks`` whose properties a codegen event of the client just had, under any name.

    ``events`` are the ones still pending.  Nothing is consumed.
    """
    pending = events.filter(F.col("source") == "codegen").select(
        "client_id", params_fingerprint(F.col("props")).alias("_params"), F.unix_millis("ts").alias("_ms"), F.lit(True).alias("_event")
    )
    asked = checks.withColumns(
        {"_params": params_fingerprint(F.col("props")), "_ms": F.unix_millis("ts"), "_event": F.lit(False)}
    )
    both = with_context(asked.unionByName(pending, allowMissingColumns=True), "_ms", WINDOW_MS, _WIDTH_MS)
    # events sort before checks of the same instant
    order = Window.partitionBy("client_id", "_params", "_bucket").orderBy("_ms", F.col("_event").desc())
    last = F.last(F.when(F.col("_event"), F.col("_ms")), True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        both.withColumn("seen_by_codegen", F.coalesce(F.col("_ms") - last <= WINDOW_MS, F.lit(False)))
        .filter(~F.col("_event") & ~F.col("_context"))
        .drop("_params", "_ms", "_event", "_bucket", "_context")
    )
