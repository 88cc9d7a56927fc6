"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths matter to a packing, and there are at most ``capacity`` of them.  So the plan is
made over the number of pieces of each length, a table of bounded size: the reduction fixes
sets that provably dominate every other way to place a piece, best fit decreasing packs what
is left, and both work on whole counts.  The plan is a short list of patterns (lengths side by
side, how often).  Each piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import array
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.shared import ID, settle

CAPACITY = 1024
END = 2
#: rows of one length that are numbered in one task
RANK_ROWS = 100_000
#: texts of other characters, or with long white space, are left to the tokenizer itself
_UNCOMMON = re.compile("[^\t-\r\x20-\x7e\xa1-ɏ]|[\t-\r\x20]{2000}")


# --------------------------------------------------------------------- tokens


@lru_cache(maxsize=2)
def tokenizer(json_path: str | None):
    """The tokenizer of ``byte_bpe_50k.json`` with its own settings: an added token in a text has one id."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))


@lru_cache(maxsize=2)
def added_tokens(json_path: str | None) -> tuple[str, ...]:
    return tuple(t.content for t in tokenizer(json_path).get_added_tokens_decoder().values())


@lru_cache(maxsize=2)
def fast_tokenizer(rank_path: str | None):
    """The same vocabulary as ranks, several times as fast."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(rank_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str, json_path: str | None = None, rank_path: str | None = None) -> list[int]:
    """Ids of a text; no special tokens are added to those it has.

    Both libraries give the same ids; they may know different versions of the character
    classes, so texts beyond Latin letters go to the one that the contract names, and so do
    texts with an added token, which the other one doesn't know, and texts with long white
    space, on which the other one's pattern overflows its stack.
    """
    if _UNCOMMON.search(text) or any(t in text for t in added_tokens(json_path)):
        return tokenizer(json_path).encode(text, add_special_tokens=False).ids
    return fast_tokenizer(rank_path).encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    head = n % capacity
    cuts = [(0, head)] if head else []
    return cuts + [(at, capacity) for at in range(head, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, rank_path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; ``END`` closes each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = array.array("I", token_ids(text or "", json_path, rank_path))
                ids.append(END)
                raw = memoryview(ids.tobytes())
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append(row)
                    for name, value in zip(out, (k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])), strict=True):
                        out[name].append(value)
            names = [ID, *out]
            types = [batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))] + [pa.array(v, t) for v, t in zip(out.values(), types[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(docs.dtypes)[ID]
    return docs.select(ID, "text").mapInArrow(run, f"{ID} {kind}, piece int, start long, length long, ids_crc32 long")


# ----------------------------------------------------------------------- plan


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets; ``counts`` (pieces per length) is left with what no rule decides.

    For the longest piece j and the space r it leaves, by Martello and Toth:
    nothing fits beside it: j goes alone; some piece fills r exactly: j and that piece; only
    one more piece fits (the two shortest exceed r): j and the longest that fits; two fit but
    never three, and the longest that fits is at least as long as any pair that does: j and it.
    """
    fixed: list[tuple[tuple[int, ...], int]] = []

    def longest_within(space: int) -> int:
        there = np.flatnonzero(counts[: max(space, 0) + 1])
        return int(there[-1]) if len(there) else 0

    for j in range(capacity, 0, -1):
        while counts[j]:
            counts[j] -= 1  # j itself is not beside j
            space = capacity - j
            best = longest_within(space)
            shortest = _shortest(counts, 3)
            one_more = len(shortest) < 2 or shortest[0] + shortest[1] > space
            if best == 0:
                chosen: tuple[int, ...] | None = ()
            elif best == space or one_more:
                chosen = (best,)
            elif (len(shortest) < 3 or sum(shortest) > space) and best >= _best_pair(counts, space):
                chosen = (best,)
            else:
                chosen = None
            counts[j] += 1
            if chosen is None:
                break
            if not chosen:
                times = int(counts[j])
            elif chosen[0] == j:
                times = int(counts[j]) // 2
            else:
                times = int(min(counts[j], counts[chosen[0]]))
            for length in (j, *chosen):
                counts[length] -= times
            fixed.append(((j, *chosen), times))
    return fixed


def _shortest(counts: np.ndarray, k: int) -> list[int]:
    out: list[int] = []
    for length in np.flatnonzero(counts)[:k]:
        out += [int(length)] * min(k, int(counts[length]))
    return out[:k]


def _best_pair(counts: np.ndarray, space: int) -> int:
    """Longest sum of two pieces within ``space``."""
    there = np.flatnonzero(counts)
    best, hi = 0, len(there) - 1
    for lo in range(len(there)):
        while hi >= lo and there[lo] + there[hi] > space:
            hi -= 1
        if hi < lo:
            break
        if hi > lo or counts[there[lo]] > 1:
            best = max(best, int(there[lo] + there[hi]))
        elif hi == lo and lo > 0:
            best = max(best, int(there[lo] + there[lo - 1]))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over counts: each piece goes where it leaves the least space."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def add(pattern: tuple[int, ...], times: int) -> None:
        open_.setdefault(capacity - sum(pattern), []).append((pattern, times))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            space = min((s for s in open_ if s >= length), default=None)
            if space is None:
                per = capacity // length
                if left >= per:  # as many new sequences as this length fills by itself
                    add((length,) * per, left // per)
                    left %= per
                else:
                    add((length,) * left, 1)
                    left = 0
                continue
            pattern, times = open_[space].pop()
            if not open_[space]:
                del open_[space]
            used = min(times, left)
            if times > used:
                add(pattern, times - used)
            add((*pattern, length), used)
            left -= used
    return [p for of in open_.values() for p in of]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they hold every piece once."""
    counts = counts.astype(np.int64).copy()
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity)


class Places:
    """For each length, which ranks go to which pattern."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        self.table: dict[int, list[tuple[int, int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for pattern, times in patterns:
            offset, each = 0, {}
            for length in pattern:
                each.setdefault(length, []).append(offset)
                offset += length
            for length, offsets in each.items():
                start = taken.get(length, 0)
                # ranks start .. start + times * len(offsets): sequence by sequence
                self.table.setdefault(length, []).append((start, base, len(offsets), offsets[0], length))
                taken[length] = start + times * len(offsets)
            base += times
        self.arrays = {n: np.array(rows, np.int64) for n, rows in self.table.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n in np.unique(lengths):
            of = lengths == n
            rows = self.arrays[int(n)]
            at = rows[np.searchsorted(rows[:, 0], ranks[of], "right") - 1]
            k = ranks[of] - at[:, 0]
            sequence[of] = at[:, 1] + k // at[:, 2]
            offset[of] = at[:, 3] + (k % at[:, 2]) * at[:, 4]
        return sequence, offset


def pack(docs: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, rank_path: str | None = None) -> DataFrame:
    """Every piece with its sequence: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end token alone.  A document longer than ``capacity`` is cut,
    its first piece being the shorter one.  Ties are ordered by id and piece; rows that repeat
    an id are pieces of their own, in either order.  An empty table gives no rows.
    """
    cut_up = settle(pieces(docs, capacity, json_path, rank_path))
    # parts of a length, so that a hot length is numbered by several tasks
    counted = cut_up.groupBy("length").agg(F.count("*").alias("n"))
    sizes = {r.length: r.n for r in counted.collect()}  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.items():
        counts[length] = n
    parts = max(1, -(-int(counts.max()) // RANK_ROWS))
    parted = cut_up.withColumn("part", F.pmod(F.xxhash64(ID, "piece"), F.lit(parts)).cast("int"))
    by_part = parted.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = by_part.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "part", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = (
        parted.withColumn("within", F.row_number().over(Window.partitionBy("length", "part").orderBy(ID, "piece", "start", "ids_crc32")))
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
    )
    places = docs.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = dict(zip(batch.schema.names, batch.columns, strict=True))
            sequence, offset = places.value.find(named["length"].to_numpy(), named.pop("rank").to_numpy())
            names = [*named, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*named.values(), pa.array(sequence), pa.array(offset)], names=names)

    kind = dict(docs.dtypes)[ID]
    shape = f"{ID} {kind}, piece int, start long, length long, ids_crc32 long"
    return ranked.select(ID, "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, f"{shape}, sequence_id long, offset long")
