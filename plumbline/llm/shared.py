"""Helpers the operators share: session options, checkpoints, and hashing of words in numpy.

Words are runs of bytes other than ASCII white space (0x20, 0x09 to 0x0D), as the contracts
define them; UTF-8 never uses these bytes inside a character, so no text is decoded.  All
hashes are functions of the bytes alone and equal in every process.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plumbline.session import ship

#: bytes of text that are hashed at once inside a task
SLICE_BYTES = 1 << 19
#: ids may be missing: such rows are kept, but never name a group
ID = "doc_id"


def prepare(spark: SparkSession) -> SparkSession:
    """Bound what one Arrow batch may hold, so that long texts don't fill a Python worker."""
    for name, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }.items():
        spark.conf.set(name, value)
    return ship(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    name = f"__{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share.

    Only where nothing names one, as in tests on one machine, a temporary folder is set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="plumbline-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, into the shared folder, and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def few_tasks(settled: DataFrame, rows: int = 250_000) -> DataFrame:
    """A settled table of narrow rows, read in no more tasks than its size needs.

    A stage writes a shuffle file for each of its tasks, so many tasks of a few rows cost more
    than their rows.
    """
    return settled.coalesce(max(1, settled.count() // rows))


# ------------------------------------------------------------------ hashing

#: hashes of different keys have nothing to do with each other
_KEYS = np.random.Generator(np.random.PCG64(20240607)).integers(1 << 62, 1 << 63, (4, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """64-bit hash of each byte range.

    Every eight bytes are mixed with their place in the range before they are added up, so no
    arrangement of equal parts cancels out, as it does in polynomials modulo a power of two.
    """
    seed, place, size = _KEYS[key]
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # eight bytes from every byte on
    sizes = ends - starts
    value = _block(eights, starts, sizes)
    value = mix(mix(value + seed) + place)
    long = np.flatnonzero(sizes > 8)
    if len(long):
        more = (sizes[long] - 1) >> 3  # blocks behind the first one
        first = np.cumsum(more) - more
        number = np.arange(int(more.sum())) - np.repeat(first, more) + 1
        at = np.repeat(starts[long], more) + 8 * number
        blocks = _block(eights, at, np.repeat(ends[long], more) - at)
        value[long] += np.add.reduceat(mix(mix(blocks + seed) + place * (number + 1).astype(np.uint64)), first)
    return mix(value + sizes.astype(np.uint64) * size)


def _block(eights: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, zeros where fewer are left."""
    unused = (8 * (8 - np.clip(left, 0, 8))).astype(np.uint64)
    value = eights[at] << (unused & np.uint64(63))
    value[unused == 64] = 0
    return value


def sequence_hash(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int = 0) -> np.ndarray:
    """Hash of the words ``start`` to ``end`` of each range, which are few: each word is mixed into all before it."""
    count = ends - starts
    out = mix(count.astype(np.uint64) * _KEYS[key, 2] + _KEYS[key, 0])
    for j in range(int(count.max()) if len(count) else 0):
        on = slice(None) if (count > j).all() else np.flatnonzero(count > j)
        out[on] = mix((out[on] ^ hashes[starts[on] + j]) + _KEYS[key, 1])
    return out


# -------------------------------------------------------------------- words


@dataclass
class Slice:
    """Some consecutive rows of a batch and their words."""

    first: int  # row of the batch
    rows: int
    data: np.ndarray  # uint8, texts one after the other
    bounds: np.ndarray  # rows + 1 offsets into data
    starts: np.ndarray  # of words
    ends: np.ndarray
    row: np.ndarray  # of each word, counted from ``first``
    words: np.ndarray  # rows + 1 offsets into the words

    def hashes(self, key: int = 0) -> np.ndarray:
        return bytes_hash(self.data, self.starts, self.ends, key)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a batch in runs of about ``size`` bytes; a longer text makes a run by itself."""
    data, offsets = text_buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield _slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def _slice(first: int, data: np.ndarray, bounds: np.ndarray) -> Slice:
    rows = len(bounds) - 1
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = inside[heads]  # a text ends where the next one starts
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    stops[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    words = np.searchsorted(starts, bounds)
    row = np.repeat(np.arange(rows), np.diff(words))
    return Slice(first, rows, data, bounds, starts, ends, row, words)


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k`` consecutive words, and which of them lie in one row."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, _KEYS[0, 0])
    for j in range(k):
        out = mix((out ^ hashes[j : j + n]) + _KEYS[0, 1])
    return out, row[:n] == row[k - 1 : k - 1 + n]
