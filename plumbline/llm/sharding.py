"""Sharding by histogram sort: exact byte counts below probe keys, refined until splitters fit.

Rows are ordered by (hash of the text, id), so equal texts stand together.  Each pass counts,
over all rows, the exact bytes and rows between the probe keys of every splitter that is not
settled; the interval that holds the wanted byte is cut into new probes for the next pass.
The probes and their counts are all that meets the driver; their number depends on the number
of splitters only.  Rows are exchanged once, by splitter interval.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, settle

#: probe keys per splitter and pass
PROBES = 32
#: bytes of one interval, of which a shard has one or more; an interval is one task's sort
INTERVAL_BYTES = 128 << 20
#: a shard may miss its share by this part of an interval, or by the bytes of one row if more
TOLERANCE = 0.001


class Line:
    """Places of (hash, id) keys on one line of integers, with room for the ids that occur."""

    def __init__(self, low: int, high: int):
        self.low, self.room = low, high - low + 1
        self.end = self.room << 64

    def key(self, place: int) -> tuple[int, int]:
        return place // self.room - (1 << 63), place % self.room + self.low


def places(h: np.ndarray, i: np.ndarray, keys: list[tuple[int, int]]) -> np.ndarray:
    """For each row, how many of the sorted keys are not above it."""
    kh = np.array([k[0] for k in keys], np.int64)
    left, right = np.searchsorted(kh, h, "left"), np.searchsorted(kh, h, "right")
    out = right.copy()
    for row in np.flatnonzero(left < right):  # the row's hash is a key's
        ids = [k[1] for k in keys[left[row] : right[row]]]
        out[row] = left[row] + bisect.bisect_right(ids, i[row])
    return out


def _count(keys: list[tuple[int, int]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = places(pdf["h"].to_numpy(), pdf["i"].to_numpy(), keys)
            yield pd.DataFrame({"place": at, "bytes": pdf["size"]}).groupby("place", as_index=False).agg(bytes=("bytes", "sum"), n=("bytes", "size"))

    return run


def find_splitters(rows: DataFrame, line: Line, total: int, parts: int, tolerance: float) -> list[tuple[int, int]]:
    """Keys that cut ``rows`` (h, i, size) into ``parts`` intervals of near equal bytes."""
    wanted = [total * p // parts for p in range(1, parts)]
    # highest known place with at most the wanted bytes below it, and lowest one with more: place, bytes and rows below
    ends = (0, 0, 0), (line.end, total, None)
    span = [ends for _ in wanted]
    done: list[int | None] = [None] * len(wanted)
    slack = max(1, int(tolerance * total / parts))
    while None in done:
        keys = sorted(
            {lo + (hi - lo) * j // (PROBES + 1) for ((lo, _, _), (hi, _, _)), d in zip(span, done, strict=True) if d is None for j in range(1, PROBES + 1)}
        )
        counted = rows.mapInPandas(_count([line.key(k) for k in keys]), "place long, bytes long, n long").groupBy("place").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        below = np.zeros((len(keys) + 1, 2), np.int64)
        for r in counted.collect():  # at most one row per probe
            below[r.place] += (r.bytes, r.n)
        below = np.cumsum(below, axis=0)
        for s, goal in enumerate(wanted):
            if done[s] is not None:
                continue
            low, high = span[s]
            for j, key in enumerate(keys):
                if low[0] < key < high[0]:
                    found = (key, int(below[j, 0]), int(below[j, 1]))
                    if found[1] <= goal:
                        low = found
                    else:
                        high = found
                        break
            span[s] = low, high
            short, over = goal - low[1], high[1] - goal
            one_row = high[2] is not None and high[2] - low[2] <= 1
            if min(short, over) <= slack or one_row or high[0] - low[0] <= 1:
                done[s] = low[0] if short <= over else high[0]
    return [line.key(k) for k in sorted(done)]


def shard_rows(docs: DataFrame, shards: int = 8, interval_bytes: int = INTERVAL_BYTES, tolerance: float = TOLERANCE) -> DataFrame:
    """Ids with size, text_crc32, law, shard, slot and grown_shard; the law is ``bytes``.

    A row's size is its UTF-8 bytes plus one; a null text has no bytes.  Rows that repeat one
    id and text have one key and so share an interval; a missing id counts as the smallest.
    Slots run from 0 without gaps in the order of (hash of the text, id).  grown_shard is null,
    as this law moves rows when shards are added.  An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col(ID),
        F.xxhash64(text).alias("h"),
        F.coalesce(F.col(ID).cast("long"), F.lit(-(1 << 63))).alias("i"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = settle(rows)  # narrow: the texts are read once
    total, low, high = rows.agg(F.sum("size"), F.min("i"), F.max("i")).first()
    total = total or 0
    parts = shards * max(1, math.ceil(total / (shards * interval_bytes)))
    keys = find_splitters(rows.select("h", "i", "size"), Line(low, high), total, parts, tolerance) if total else []

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(part=places(pdf["h"].to_numpy(), pdf["i"].to_numpy(), keys))

    placed = rows.mapInPandas(place, f"{ID} {dict(rows.dtypes)[ID]}, h long, i long, size long, text_crc32 long, part long")
    counts = dict.fromkeys(range(parts), 0)
    per_part = rows.select("h", "i", "size").mapInPandas(_count(keys), "place long, bytes long, n long")
    for r in per_part.groupBy("place").agg(F.sum("n").alias("n")).collect():  # one row per interval
        counts[r.place] = r.n
    per_shard = parts // shards
    before = [sum(counts[q] for q in range(p - p % per_shard, p)) for p in range(parts)]
    first = F.element_at(F.lit(before).cast("array<bigint>"), (F.col("part") + 1).cast("int"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("h", "i"))
    return placed.select(
        ID,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        (F.col("part") / per_shard).cast("int").alias("shard"),
        (first + within - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
