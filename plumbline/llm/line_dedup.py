"""Line dedup: range-partitioned line hashes, first occurrences streamed, keep bitmaps returned.

A line's key is the line without white space (0x20, 0x09 to 0x0D) at its ends, A to Z lower-cased;
it travels as a 128-bit cryptographic hash with the document and the line's place, never as text.
The rows are range-partitioned by hash, document (largest first) and place and sorted that way, so
a key that a third of all documents hold is cut over as many partitions as its rows need.  Each
task streams its rows once and remembers one key, its first documents and the lines that wait
for another one: lines of a third or later document go, those of the second one go as soon as a
third one shows, and those of the first one stay.

Only the first and the last key of a task may go on in another one.  Of these a task reports up
to three documents, and the lines it could not decide, which belong to two documents at most.
The reports, a few rows from each task, decide them.

What a document loses is one compressed bitmap; texts meet their bitmaps at the very end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, settle

#: fixed values of the contract
SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: rows of one output batch
BATCH_ROWS = 50_000
#: kinds of rows that the scan gives
GONE, OPEN, REPORT = 0, 1, 2
_ROW = ["hi", "lo", "id", "twin", "line"]
_SHAPE = "hi long, lo long, id long, twin long, line int"


def _texts(docs: DataFrame) -> DataFrame:
    """id, twin, text; ``twin`` tells rows that repeat an id with another text."""
    return docs.select(F.col(ID).cast("long").alias("id"), F.xxhash64("text").alias("twin"), "text")


def _raw(column: pa.Array) -> Iterator[bytes | None]:
    """Texts as bytes, one at a time."""
    return (value.as_py() for value in column.cast(pa.large_binary()))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held: list[tuple] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield packed()
            held = []
    if held:
        yield packed()


# ----------------------------------------------------------------------- keys


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> Iterator[tuple[int, bytes]]:
    """Place and 128-bit hash of every line whose key is long enough."""
    for place, line in enumerate(text.lower().split(b"\n")):  # bytes lower-case A to Z only
        key = line.strip(SPACE)
        if len(key) < min_chars:
            continue
        if key.isascii() or np.count_nonzero((np.frombuffer(key, np.uint8) & 0xC0) != 0x80) >= min_chars:
            yield place, blake2b(key, digest_size=16).digest()


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """hi, lo, id, twin, line of every line whose key is long enough; rows without an id give none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        signed = lambda b: int.from_bytes(b, "big", signed=True)
        for batch in batches:
            for i, twin, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch.column(2)), strict=True):
                for place, key in line_keys(text, min_chars):
                    yield signed(key[:8]), signed(key[8:]), i, twin, place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), _ROW, [pa.int64()] * 4 + [pa.int32()])

    return _texts(docs).filter("id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, _SHAPE)


# ----------------------------------------------------------------------- scan


def scan_rows(rows: Iterator[tuple], min_docs: int) -> Iterator[tuple]:
    """(kind, hi, lo, id, twin, line) from one task's rows, sorted by key, document and place."""
    key, first = None, True  # whether the key is the first one of the task
    docs: list[int] = []  # the key's first documents
    waiting: list[tuple] = []  # rows behind the first document, until there are ``min_docs``
    rank, doc = -1, None

    def leave(edge: bool) -> Iterator[tuple]:
        if edge:
            yield from ((REPORT, *key, d, 0, 0) for d in docs)
            yield from ((OPEN, *row) for row in waiting)

    for row in rows:
        if row[:2] != key:
            yield from leave(edge=key is not None and first)
            first = key is None
            key, docs, waiting, rank, doc = row[:2], [], [], -1, None
        if row[2] != doc:
            rank, doc = rank + 1, row[2]
            if rank < min_docs:
                docs.append(doc)
            if rank == min_docs - 1:
                yield from ((GONE, *r) for r in waiting)
                waiting = []
        if rank == 0:
            if first:
                yield (OPEN, *row)  # a task before this one may have a larger document
        elif rank >= min_docs - 1:
            yield (GONE, *row)
        else:
            waiting.append(row)
    yield from leave(edge=key is not None)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """id, twin, line of every line that goes."""
    if min_docs < 2:
        raise ValueError("a line that goes is in one document besides the one that keeps it, at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        return _batches(scan_rows(rows, min_docs), ["kind", *_ROW], [pa.int32()] + [pa.int64()] * 4 + [pa.int32()])

    # rows that repeat id and text would stand in one place of the order
    lines = settle(line_rows(docs, min_chars).distinct())
    order = [F.col("hi"), F.col("lo"), F.col("id").desc(), F.col("twin"), F.col("line")]
    found = settle(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"kind int, {_SHAPE}"))
    # up to ``min_docs`` rows for each of two keys of a task
    reports = found.filter(F.col("kind") == REPORT).select("hi", "lo", "id").distinct()
    crowded = reports.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= min_docs)
    decided = found.filter(F.col("kind") == OPEN).join(F.broadcast(crowded), ["hi", "lo"]).filter("id <> keeper")
    return found.filter(F.col("kind") == GONE).select("id", "twin", "line").unionByName(decided.select("id", "twin", "line"))


# -------------------------------------------------------------------- bitmaps


def to_bitmap(dropped: np.ndarray) -> bytes:
    """Compressed bitmap of the places: 0 for a line that goes; lines beyond the last bit stay."""
    keep = np.ones(int(dropped.max()) + 1 if len(dropped) else 0, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(~keep, bitorder="little").tobytes(), 6)


def kept_lines(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """For each line, whether it stays."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        gone = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n_lines]
        keep[: len(gone)] = gone == 0
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """id, twin, keep: the bitmap of every document that loses lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [to_bitmap(places.values.to_numpy()) for places in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], names=["id", "twin", "keep"])

    places = dropped_lines(docs, min_chars, min_docs).groupBy("id", "twin").agg(F.collect_set("line").alias("places"))
    return places.mapInArrow(run, "id long, twin long, keep binary")


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, with_text: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 and keep (bitmap or null) of every row; ``with_text`` adds kept_text.

    Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold lose
    their lines in all documents but the one with the largest id, which keeps all of its own.
    Documents are told apart by id: rows that repeat an id count once, and lose and keep alike.
    Rows without an id count for nothing and keep all.  A null or empty text is one empty line.
    An empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[ID]
    marked = _texts(docs).join(keep_bitmaps(docs, min_chars, min_docs), ["id", "twin"], "left").select("id", "text", "keep")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, bitmap in zip(_raw(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                kept = lines
                if bitmap is not None:
                    kept = [line for line, stays in zip(lines, kept_lines(bitmap, len(lines)).tolist(), strict=True) if stays]
                body = b"\n".join(kept)
                out.append((len(lines), len(lines) - len(kept), sha256(body).hexdigest(), body if with_text else None))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            columns = [batch.column(0), *columns[:3], batch.column(2), *([columns[3].cast(pa.string())] if with_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n_lines", "n_dropped", "kept_sha256", "keep", *(["kept_text"] if with_text else [])]
    shape = "id long, n_lines long, n_dropped long, kept_sha256 string, keep binary" + (", kept_text string" if with_text else "")
    result = marked.mapInArrow(rows, shape)
    return result.select(F.col("id").cast(kind).alias(ID), *names[1:])
