"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is a path through the lattice of its pieces.  Where no piece holds two neighbouring
bytes side by side, every path has a node between them; the lattice falls apart there into
units, and a path is sampled unit by unit without changing its distribution.  The forward pass is
done once for each distinct unit of a slice, the backward pass for all units of the slice at
once, one piece per step; both are array operations.  The random number at a place depends on
the row's key and the place only, so a row is segmented alike wherever and whenever it runs.

The model file ranks its pieces (merges) instead of giving probabilities; a piece weighs
``(rank + 1) ** -alpha``, scaled to sum to one.  Characters without a piece of their own fall back to their bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from plumbline.llm.shared import ID, bytes_hash, mix, text_buffers

ALPHA = 1.0
SLICE = 1 << 20
#: places of units that a worker keeps from one slice to the next
KEPT_NODES = 2_000_000
#: log weight of a byte that stands for a character without a piece
_BYTE_WEIGHT = -16.0
_GLUE = np.uint64(0x2545F4914F6CDD1D)
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 32, 1 << 62)) | 5
_powers: list[np.ndarray] = []


class Pieces:
    """Vocabulary as hash table from piece bytes to ids and log weights."""

    def __init__(self, path: str | None, alpha: float):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        self.size = model.vocab_size()
        self.raw: list[bytes] = [b""] * self.size
        self.weight = np.full(self.size, _BYTE_WEIGHT)
        self.byte_id = np.zeros(256, np.int64)
        plain = []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.raw[i] = bytes([int(piece[1:-1], 16)])
                self.byte_id[self.raw[i][0]] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.raw[i] = piece.replace("▁", " ").encode()
                self.weight[i] = -alpha * np.log1p(max(0.0, -model.get_score(i)))
                plain.append(i)
        # weights of all plain pieces sum to one
        self.weight[plain] -= np.log(np.exp(self.weight[plain]).sum())
        self.longest = max(len(self.raw[i]) for i in plain)
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(r) for r in self.raw])])
        self.lengths = np.unique([len(self.raw[i]) for i in plain])
        # pairs of bytes that stand side by side in some piece
        self.joins = np.zeros(1 << 16, bool)
        for i in plain:
            raw = np.frombuffer(self.raw[i], np.uint8).astype(np.intp)
            self.joins[(raw[:-1] << 8) | raw[1:]] = True
        # open addressing over the hashes of all plain pieces
        self.bits = 20
        self.slot_hash = np.zeros(1 << self.bits, np.uint64)
        self.slot_id = np.full(1 << self.bits, -1, np.int64)
        starts = np.array([self.at[i] for i in plain])
        ends = np.array([self.at[i + 1] for i in plain])
        self.probes = 1
        for i, h in zip(plain, range_sums(self.flat).of(starts, ends), strict=True):
            slot, n = int(h >> np.uint64(64 - self.bits)), 1
            while self.slot_id[slot] >= 0:
                slot, n = (slot + 1) % (1 << self.bits), n + 1
            self.slot_hash[slot], self.slot_id[slot] = h, i
            self.probes = max(self.probes, n)

        self.used = self.slot_id >= 0
        self.kept: Lattice | None = None  # units of earlier slices

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, or -1."""
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.flatnonzero(self.used[slot])
        slot = slot[open_]
        for _ in range(self.probes):
            hit = self.slot_hash[slot] == hashes[open_]
            out[open_[hit]] = self.slot_id[slot[hit]]
            slot = (slot + 1) % (1 << self.bits)
            more = ~hit & self.used[slot]
            open_, slot = open_[more], slot[more]
        return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        m = 1 << max(16, (n - 1).bit_length())
        _powers.clear()
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            column = np.full(m, b, np.uint64)
            column[0] = 1
            _powers.append(np.multiply.accumulate(column))
    return _powers[0][:n], _powers[1][:n]


class range_sums:  # noqa: N801
    """Prefix sums from which a hash of any byte range follows; what it finds is compared byte by byte."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether each range of ``data`` holds the bytes of its range of ``other``."""
    sizes = ends - starts
    same = sizes == to - at
    rows = np.flatnonzero(same & (sizes > 0))
    n = sizes[rows]
    first = np.cumsum(n) - n
    step = np.arange(int(n.sum())) - np.repeat(first, n)
    unlike = data[np.repeat(starts[rows], n) + step] != other[np.repeat(at[rows], n) + step]
    if len(rows):
        same[rows] = ~np.logical_or.reduceat(unlike, first)
    return same


def distinct_units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first place of each distinct unit, and which one every unit is; equal means equal bytes."""
    hashes = bytes_hash(data, starts, ends)
    distinct, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~same_bytes(data, starts, ends, data, starts[sample[which]], ends[sample[which]]))
    if len(odd):  # units that share a hash with an unlike one
        named: dict[bytes, int] = {}
        for unit in odd.tolist():
            named.setdefault(data[starts[unit] : ends[unit]].tobytes(), unit)
        numbers = {raw: len(distinct) + k for k, raw in enumerate(named)}
        which[odd] = [numbers[data[starts[unit] : ends[unit]].tobytes()] for unit in odd.tolist()]
        sample = np.concatenate([sample, list(named.values())])
        distinct = np.concatenate([distinct, hashes[list(named.values())]])
    return distinct, sample, which


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None, alpha: float = ALPHA) -> Pieces:
    return Pieces(path, alpha)


def units(data: np.ndarray, bounds: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Starts of the units: text fronts, and characters that no piece joins to the byte before."""
    head = np.zeros(len(data) + 1, bool)
    pair = (data[:-1].astype(np.intp) << 8) | data[1:]
    head[1:-1] = ~pieces.joins[pair] & ((data[1:] & 0xC0) != 0x80)
    head[bounds] = True
    return np.flatnonzero(head[:-1])


class Lattice:
    """Forward-filtered lattices of distinct units, laid side by side."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, pieces: Pieces):
        # bytes of the units one after the other; node b of a unit is the place before its byte b
        sizes = ends - starts
        base = np.concatenate([[0], np.cumsum(sizes)])
        flat = data[np.repeat(starts - base[:-1], sizes) + np.arange(base[-1])]
        unit_end = np.repeat(base[1:], sizes)
        sums = range_sums(flat)
        place = np.arange(len(flat))
        lead = (flat & 0xC0) != 0x80
        heads = place[lead]
        froms, tos, ids = [], [], []
        s, room = heads, unit_end[heads] - heads
        for n in pieces.lengths:
            fits = room >= n
            if not fits.all():
                s, room = s[fits], room[fits]
            found = pieces.find(sums.of(s, s + n))
            hit = np.flatnonzero(found >= 0)
            at = pieces.at[found[hit]]
            hit = hit[same_bytes(flat, s[hit], s[hit] + n, pieces.flat, at, pieces.at[found[hit] + 1])]
            froms.append(s[hit])
            tos.append(s[hit] + n)
            ids.append(found[hit])
        # characters without a piece: their bytes
        next_lead = np.append(heads[1:], len(flat))
        width = np.minimum(next_lead, unit_end[heads]) - heads
        whole = np.zeros(len(flat), bool)
        f, t = np.concatenate(froms), np.concatenate(tos)
        char_end = np.zeros(len(flat), np.int64)
        char_end[heads] = heads + width
        whole[f[t == char_end[f]]] = True
        alone = heads[~whole[heads]]
        loose = np.repeat(alone, char_end[alone] - alone)
        first = np.repeat(np.cumsum(char_end[alone] - alone) - (char_end[alone] - alone), char_end[alone] - alone)
        loose = loose + np.arange(len(loose)) - first
        # ends are nodes too: unit u owns nodes base[u] + u .. base[u + 1] + u
        shift = np.repeat(np.arange(len(sizes)), sizes)
        e_from = np.concatenate([f, loose])
        e_len = np.concatenate([t - f, np.ones(len(loose), np.int64)])
        e_id = np.concatenate([*ids, pieces.byte_id[flat[loose]]])
        node_from = e_from + shift[e_from]
        node_to = node_from + e_len
        local = node_to - (base[:-1] + np.arange(len(sizes)))[shift[e_from]]
        by_node = np.argsort(node_to, kind="stable")
        node_from, node_to, e_id, local = node_from[by_node], node_to[by_node], e_id[by_node], local[by_node]
        # all units advance together, level by level
        narrow = local.astype(np.uint16) if len(local) and local.max() < 1 << 16 else local
        level = np.argsort(narrow, kind="stable")
        a = np.full(len(flat) + len(sizes), -np.inf)
        a[base[:-1] + np.arange(len(sizes))] = 0.0
        weight = pieces.weight[e_id]
        levels = np.concatenate([[0], np.cumsum(np.bincount(local))])
        chance = np.zeros(len(local))
        for lo, hi in zip(levels[:-1], levels[1:], strict=True):
            if lo == hi:
                continue
            at = level[lo:hi]
            value = a[node_from[at]] + weight[at]
            nodes = node_to[at]
            new = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
            count = np.diff(np.append(new, hi - lo))
            top = np.maximum.reduceat(value, new)
            top[~np.isfinite(top)] = 0.0  # a node inside a character, which no path reaches
            value = np.exp(value - np.repeat(top, count))
            total = np.add.reduceat(value, new)
            with np.errstate(divide="ignore"):
                a[nodes[new]] = top + np.log(total)
            chance[at] = value / np.repeat(np.maximum(total, 1e-300), count)
        self.node_from, self.edge_id = node_from, e_id.astype(np.int32)
        self.edge_at = np.searchsorted(node_to, np.arange(len(a) + 1))
        # summed edge by edge, so that a unit's numbers don't depend on its neighbours
        self.upto = chance
        degree = np.diff(self.edge_at)
        of_rank = np.flatnonzero(degree > 1)
        rank = 1
        while len(of_rank):
            edge = self.edge_at[of_rank] + rank
            self.upto[edge] += self.upto[edge - 1]
            rank += 1
            of_rank = of_rank[degree[of_rank] > rank]
        self.first_node = base[:-1] + np.arange(len(sizes))
        self.last_node = base[1:] + np.arange(len(sizes))

        self.hashes = hashes
        self.flat, self.start, self.end = flat, base[:-1], base[1:]

    def joined(self, other: Lattice) -> Lattice:
        """Both sets of units in one lattice; ``hashes`` stay sorted."""
        out = Lattice.__new__(Lattice)
        nodes, edges = len(self.edge_at) - 1, len(self.node_from)
        out.node_from = np.concatenate([self.node_from, other.node_from + nodes])
        out.edge_id = np.concatenate([self.edge_id, other.edge_id])
        out.upto = np.concatenate([self.upto, other.upto])
        out.edge_at = np.concatenate([self.edge_at[:-1], other.edge_at + edges])
        hashes = np.concatenate([self.hashes, other.hashes])
        order = np.argsort(hashes, kind="stable")
        out.hashes = hashes[order]
        out.first_node = np.concatenate([self.first_node, other.first_node + nodes])[order]
        out.last_node = np.concatenate([self.last_node, other.last_node + nodes])[order]
        out.flat = np.concatenate([self.flat, other.flat])
        out.start = np.concatenate([self.start, other.start + len(self.flat)])[order]
        out.end = np.concatenate([self.end, other.end + len(self.flat)])[order]
        return out

    def step(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge into each node that a uniform number picks."""
        edge, last = self.edge_at[node].copy(), self.edge_at[node + 1] - 1
        open_ = np.flatnonzero(edge < last)
        while len(open_):
            open_ = open_[self.upto[edge[open_]] <= u[open_]]
            edge[open_] += 1
            open_ = open_[edge[open_] < last[open_]]
        return edge


def lattices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, pieces: Pieces):
    """Lattices for these distinct units, each with the numbers of the units it holds.

    A worker keeps the units of its first slices, which are most of all running text; the
    others of a slice get a lattice for that slice only.
    """
    kept = pieces.kept
    if kept is None:
        alone = np.unique(hashes, return_index=True)[1]  # sorted, one unit of each hash
        pieces.kept = Lattice(data, starts[alone], ends[alone], hashes[alone], pieces)
        kept = pieces.kept
    at = np.minimum(np.searchsorted(kept.hashes, hashes), len(kept.hashes) - 1)
    known = kept.hashes[at] == hashes
    known[known] = same_bytes(data, starts[known], ends[known], kept.flat, kept.start[at[known]], kept.end[at[known]])
    found = [(kept, np.flatnonzero(known), at[known])]
    new = np.flatnonzero(~known)
    if len(new):
        lattice = Lattice(data, starts[new], ends[new], hashes[new], pieces)
        found.append((lattice, new, np.arange(len(new))))
        # a clash of two hashes is left to its slice
        if len(kept.edge_at) < KEPT_NODES and not np.isin(hashes[new], kept.hashes).any() and len(np.unique(hashes[new])) == len(new):
            pieces.kept = kept.joined(lattice)
    return found


def encode_slice(data: np.ndarray, bounds: np.ndarray, seeds: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of the texts, and their offsets."""
    rows = len(bounds) - 1
    full = np.diff(bounds) > 0
    # every text that isn't empty gets the space that stands before its first word
    grown = np.empty(len(data) + int(full.sum()), np.uint8)
    new_bounds = bounds + np.concatenate([[0], np.cumsum(full)])
    mask = np.ones(len(grown), bool)
    mask[new_bounds[:-1][full]] = False
    grown[mask] = data
    grown[~mask] = 32
    starts = units(grown, new_bounds, pieces)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
    ends = np.append(starts[1:], len(grown))
    row = np.searchsorted(new_bounds, starts, "right") - 1
    row = np.maximum.accumulate(row)
    distinct, sample, which = distinct_units(grown, starts, ends)
    took = np.zeros(len(starts), np.int64)
    steps = []
    seeds = seeds[row]
    place = starts - new_bounds[row]
    for lattice, mine, theirs in lattices(grown, starts[sample], ends[sample], distinct, pieces):
        number = np.full(len(distinct), -1)
        number[mine] = theirs
        number = number[which]
        unit = np.flatnonzero(number >= 0)
        node, goal = lattice.last_node[number[unit]], lattice.first_node[number[unit]]
        # what leads from a node to its place in its row, for the random numbers
        offset, seed = place[unit] - goal, seeds[unit]
        while len(unit):
            u = mix(seed + (node + offset).astype(np.uint64) * _GLUE)
            edge = lattice.step(node, (u >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            steps.append((unit, took[unit] + 1, lattice.edge_id[edge]))
            took[unit] += 1
            node = lattice.node_from[edge]
            on = node != goal
            unit, node, goal, offset, seed = unit[on], node[on], goal[on], offset[on], seed[on]
    at = np.concatenate([[0], np.cumsum(took)])
    ids = np.empty(at[-1], np.int32)
    for unit, back, chosen in steps:
        ids[at[unit + 1] - back] = chosen
    first_unit = np.searchsorted(starts, new_bounds)
    return ids, at[first_unit]


def decode_slice(ids: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts and their offsets; exact inverse of any encoding of them."""
    sizes = pieces.at[ids + 1] - pieces.at[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = pieces.flat[np.repeat(pieces.at[ids] - ends[:-1], sizes) + np.arange(ends[-1])]
    bounds = ends[offsets]
    full = np.diff(bounds) > 0
    mask = np.ones(len(data), bool)
    mask[bounds[:-1][full]] = False
    return data[mask], bounds - np.concatenate([[0], np.cumsum(full)])


def row_seed(key, seed: int) -> int:
    return xxhash.xxh64_intdigest(b"" if key is None else str(key).encode(), seed)


def sample_encode(docs: DataFrame, seed: int = 0, alpha: float = ALPHA, model: str | None = None, key: str = ID) -> DataFrame:
    """key, ids (array<int>), n_pieces, ids_crc32, decoded_sha256 and lossless of every text.

    Null and empty texts have no ids and decode to the empty text.  Rows that repeat a key and
    a text get equal ids; a missing key is a key like any other.  An empty table gives no
    rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model, alpha)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            seeds = np.array([row_seed(k, seed) for k in batch.column(0).to_pylist()], np.uint64)
            first, n = 0, batch.num_rows
            while first < n:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
                part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                ids, at = encode_slice(part, bounds, seeds[first:last], pieces)
                text, cuts = decode_slice(ids, at, pieces)
                counts = np.diff(at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                        pa.array(counts),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.int64()),
                        pa.array([sha256(text[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]),
                        pa.array([np.array_equal(text[a:b], part[c:d]) for a, b, c, d in zip(cuts[:-1], cuts[1:], bounds[:-1], bounds[1:], strict=True)]),
                    ],
                    names=[key, "ids", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"],
                )
                first = last

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(
        run, f"{key} {kind}, ids array<int>, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean"
    )


def decode_ids(encoded: DataFrame, model: str | None = None, key: str = ID) -> DataFrame:
    """key and text of rows with ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model, ALPHA)
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                raw = None if ids is None else b"".join([pieces.raw[i] for i in ids])
                texts.append(None if raw is None else raw[1:].decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {dict(encoded.dtypes)[key]}, text string")
