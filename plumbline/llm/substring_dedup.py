"""Substring dedup by seed and extend over winnowed anchors.

Of every ``window`` consecutive words the ``k``-word gram with the smallest hash is the anchor
(the first of equal ones), so equal windows have equal anchors at equal places, and the
windows of a document fall into runs that share one.  An anchor with its run of windows is a
seed; its content is extended as far to both sides as those windows reach.

1. Seeds meet by anchor.  Equal seeds repeat as a whole: all but those of the smallest id are
   covered, and only the smallest goes on.  Anchors that meet one content only are done.
2. What is left are anchors with different surroundings, the ends of repeated passages.  They
   are extended word by word: the windows of the remaining seeds meet by window and anchor, and
   a window that a smaller id has is covered.

Covered windows that touch or overlap are one maximal repeat.  Inside a batch of rows only the
smallest id of equal seeds is sent on; the others are settled there, so a passage that a third
of all documents share brings one row per batch into a task, not one per document.

Words count as equal if two 64-bit hashes agree, that of their anchor and that of all of them, which
start from unrelated hashes of every word.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, Slice, grams, mix, sequence_hash, settle, slices

WINDOW = 13
GRAM = 5
_KEYS = "anchor long, content long, id long, twin long, start int, n int"
_NAMES = ["anchor", "content", "id", "twin", "start", "n"]


def _contents(part: Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of words, from hashes of the words that have nothing to do with those of the anchors."""
    return sequence_hash(part.hashes(1), starts, ends, 1)


def seeds(part: Slice, window: int, k: int) -> tuple[np.ndarray, ...]:
    """anchor, content, row, first window, windows of every seed of a slice."""
    hashes = part.hashes()
    gram, _ = grams(hashes, part.row, k)
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    inside = part.row[:n] == part.row[window - 1 :]
    at = np.lib.stride_tricks.sliding_window_view(gram, window - k + 1)[:n].argmin(axis=1) + np.arange(n)
    first = inside.copy()
    first[1:] &= (at[1:] != at[:-1]) | ~inside[:-1] | (part.row[1:n] != part.row[: n - 1])
    starts = np.flatnonzero(first)
    count = np.add.reduceat(inside, starts) if len(starts) else starts
    # reduceat runs to the next start, over windows that cross rows, which count nothing
    count = count.astype(np.int64)
    reach = starts + count - 1 + window
    content = _contents(part, starts, reach) ^ mix((at[starts] - starts).astype(np.uint64))
    return gram[at[starts]], content, part.row[starts], starts - part.words[part.row[starts]], count


def windows(part: Slice, row: np.ndarray, start: np.ndarray, count: np.ndarray, window: int, k: int):
    """anchor, content, row and place of the given windows, one by one."""
    hashes = part.hashes()
    gram, _ = grams(hashes, part.row, k)
    total = int(count.sum())
    step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    rows = np.repeat(row, count)
    place = np.repeat(start, count) + step
    at = part.words[rows] + place
    picked = np.lib.stride_tricks.sliding_window_view(gram, window - k + 1)[at].argmin(axis=1) + at if total else at
    return gram[picked], _contents(part, at, at + window), rows, place


def _settle_inside(anchor, content, ids, twin, start, n) -> pa.RecordBatch:
    """Rows to send: for equal (anchor, content) those of the smallest id; others are covered here.

    Covered rows travel under a key of their own document (``n`` below zero marks them).
    """
    order = np.lexsort((ids, content, anchor))
    a, c, i = anchor[order], content[order], ids[order]
    new = np.append(True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])) if len(order) else np.zeros(0, bool)
    least = i[new][np.cumsum(new) - 1] if len(order) else i
    done = np.zeros(len(order), bool)
    done[order] = i > least
    own = mix(ids.view(np.uint64) ^ twin.view(np.uint64))
    key = np.where(done, own, anchor)
    columns = [key.view(np.int64), content.view(np.int64), ids, twin, start.astype(np.int32), np.where(done, -n, n).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_NAMES)


def _texts(docs: DataFrame) -> DataFrame:
    """id, twin, text of rows with an id; ``twin`` tells rows that repeat an id with another text."""
    return docs.filter(F.col(ID).isNotNull()).select(F.col(ID).cast("long").alias("id"), F.xxhash64("text").alias("twin"), "text")


def _seed_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = []
            for part in slices(batch.column(2)):
                anchor, content, row, start, n = seeds(part, window, k)
                found.append((anchor, content, ids[part.first + row], twins[part.first + row], start, n))
            if found:
                yield _settle_inside(*[np.concatenate(c) for c in zip(*found, strict=True)])

    return run


def _window_rows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spans, found = batch.column(3), []
            offsets = spans.offsets.to_numpy()
            start, count = (spans.values.field(i).to_numpy() for i in range(2))
            for part in slices(batch.column(2)):
                lo, hi = offsets[part.first], offsets[part.first + part.rows]
                row = np.repeat(np.arange(part.rows), np.diff(offsets[part.first : part.first + part.rows + 1]))
                anchor, content, rows, place = windows(part, row, start[lo:hi].astype(np.int64), count[lo:hi].astype(np.int64), window, k)
                found.append((anchor, content, ids[part.first + rows], twins[part.first + rows], place, np.ones(len(rows), np.int64)))
            if found:
                yield _settle_inside(*[np.concatenate(c) for c in zip(*found, strict=True)])

    return run


def covered_windows(docs: DataFrame, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """id, twin, start, n: runs of windows whose words also start in a document with a smaller id."""
    texts = _texts(docs)
    same, of_anchor = Window.partitionBy("anchor", "content"), Window.partitionBy("anchor")
    met = (
        texts.mapInArrow(_seed_rows(window, k), _KEYS)
        .repartition("anchor")
        .withColumn("least", F.min("id").over(same))
        .withColumn("mixed", F.min("content").over(of_anchor) != F.max("content").over(of_anchor))
    )
    covered = (F.col("n") < 0) | (F.col("least") < F.col("id"))
    # of equal seeds only those of the smallest id can still lend or lose windows
    open_ = F.col("mixed") & ~covered
    marks = settle(met.filter(covered | open_).select("id", "twin", "start", F.abs("n").alias("n"), covered.alias("covered")))
    runs = marks.filter("covered").select("id", "twin", "start", "n")
    rest = marks.filter("NOT covered").groupBy("id", "twin").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    extended = (
        texts.join(rest, ["id", "twin"])
        .select("id", "twin", "text", "spans")
        .mapInArrow(_window_rows(window, k), _KEYS)
        .withColumn("least", F.min("id").over(same))
        .filter(covered)
    )
    return runs.unionByName(extended.select("id", "twin", "start", F.abs("n").alias("n")))


def cover(n_words: int, start: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Words inside the windows."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + n - 1 + window, -1)
    return np.cumsum(change)[:n_words] > 0


def substring_dedup(docs: DataFrame, window: int = WINDOW, k: int = GRAM, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and repeats of every row; ``with_text`` adds kept_text.

    A word goes if a ``window`` of words that covers it also starts in a document with a
    smaller id; ``repeats`` are the maximal runs of such words as (start, end) word positions.
    Documents are compared with all others as they came.  A null text has no words, and a text
    shorter than a window keeps all.  Rows without an id neither take nor lose words; rows that
    repeat an id don't take words from each other.  An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[ID]
    marks = covered_windows(docs, window, k).groupBy("id", "twin").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    # the same selection of texts as in covered_windows, so that one exchange of them serves both
    marked = _texts(docs).join(marks, ["id", "twin"], "left").select("id", "text", "spans")
    unnamed = docs.filter(F.col(ID).isNull()).select(F.lit(None).cast("long"), "text", F.lit(None).cast(marked.schema["spans"].dataType))
    marked = marked.union(unnamed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], [], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text or "").encode().split()
                kept, repeats = words, []
                if spans.is_valid:
                    start, n = (spans.values.field(i).to_numpy().astype(np.int64) for i in range(2))
                    gone = cover(len(words), start, n, window)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    repeats = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                body = b" ".join(kept)
                values = (len(words), len(words) - len(kept), sha256(body).hexdigest(), repeats, body.decode() if with_text else None)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], span)]
            names = ["id", "n_words", "n_removed", "kept_sha256", "repeats"]
            if with_text:
                columns.append(pa.array(out[4], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = "id long, n_words long, n_removed long, kept_sha256 string, repeats array<struct<start:int,end:int>>"
    result = marked.mapInArrow(run, shape + (", kept_text string" if with_text else ""))
    return result.select(F.col("id").cast(kind).alias(ID), *[c for c in result.columns if c != "id"])
