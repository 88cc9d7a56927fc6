"""N-gram Jaccard join with PartEnum signatures.

A document is the set of hashes of its ``k``-word shingles.  Sets of a Jaccard similarity of
``t`` or more differ in at most ``(1 - t) / (1 + t)`` of the sum of their sizes.  Sizes are cut
into bands (powers of two); sets meet inside a band, and sets near a border also meet across
it.  For each such instance the domain of shingles is cut into parts, a few more than there can
be differences between any two of its sets.  The subsets enumerated are the single parts: a
similar pair agrees on more parts than either set leaves empty, so it shares the signature
(hash of the shingles there) of a part that isn't empty.  Sets for which that count does not
hold also sign their empty parts.

Candidates come from equal signatures:

* A signature of up to ``SMALL`` sets gives all its pairs, a larger one the pairs of one of its
  sets with the others.  Parity sketches rule most of them out: the bits in which two sketches
  differ are at most as many as the sets' differences.
* For larger ones, each set counts how many of its parts are in large groups.  If a similar pair
  must agree on more parts than that, the pair has met in a small group.  The other sets are
  open.  Those that signatures connect form a family, and a family that is not one component
  yet is compared inside tasks, block of sets by block of sets, on the sketches.

Pairs that the sketches leave are verified on the texts.

No link is lost, and no group is expanded into rows of pairs.  Texts with one set are one
node.  Rows travel as (signature, node).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.components import connected_components
from plumbline.llm.shared import ID, Slice, few_tasks, fresh, grams, mix, sequence_hash, settle, slices

SHINGLE = 5
#: sets of a signature that are paired directly
SMALL = 6
#: documents whose signatures are sorted together in a task
SIGNED_ROWS = 1500
#: sets of one signature and such a part of a batch that are sent by themselves, not through the group
CROWD = 64
#: sets of a block, in expectation
BLOCK = 256
#: candidate sets whose ids are broadcast (16 bytes each); more are joined by a shuffle
BROADCAST_NODES = 500_000
#: bits of a set's name that are not used; shorter names clash more often
UNUSED_BITS = np.uint64(0)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.zeros(0, np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ----------------------------------------------------------------------- sets


def shingles(part: Slice, k: int, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a slice, sorted by row and hash."""
    part.data = _LOWER[part.data]
    hashes = part.hashes(key)
    gram, inside = grams(hashes, part.row, k)
    rows, values = part.row[: len(gram)][inside], gram[inside]
    count = np.diff(part.words)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = mix(sequence_hash(hashes, part.words[short], part.words[short + 1], key) ^ _GOLD)
        rows, values = np.concatenate([rows, short]), np.concatenate([values, whole])
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.append(True, (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])) if len(rows) else np.zeros(0, bool)
    return rows[new], values[new]


def sizes_and_keys(part: Slice, k: int, clashing: np.ndarray = _NONE, checked: bool = True) -> tuple[np.ndarray, ...]:
    """Set sizes, name and check of each set (two unrelated 64-bit hashes), and the sets themselves.

    A set whose name is one of the ``clashing`` ones, which several sets have, takes a name made
    of both.  Without ``checked`` the check is left out where no name clashes.
    """
    rows, values = shingles(part, k)
    size = np.bincount(rows, minlength=part.rows)
    key = _sums(part, rows, mix(values ^ _GOLD)) >> UNUSED_BITS
    check = _sums(part, *shingles(part, k, 1)) if checked or len(clashing) else np.zeros_like(key)
    again = np.isin(key, clashing)
    while again.any():
        key[again] = mix(key[again] ^ mix(check[again] + _GOLD))
        again = again & np.isin(key, clashing)
    return size, key, check, rows, values


def _sums(part: Slice, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(part.rows, np.uint64)
    if len(rows):
        heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        out[rows[heads]] = mix(np.add.reduceat(mix(values), heads))
    return out


# ----------------------------------------------------------------- signatures


class Scheme:
    """Instances of the join: which sets take part, and into how many parts the domain is cut.

    Similarity is ``percent`` of 100, so that all bounds are whole numbers.
    """

    def __init__(self, percent: int):
        self.percent = percent

    def differences(self, total: np.ndarray) -> np.ndarray:
        """Most differences of two similar sets whose sizes sum to ``total``."""
        return (100 - self.percent) * total // (100 + self.percent)

    def largest(self, size: np.ndarray) -> np.ndarray:
        """Largest set that can be similar to one of ``size``."""
        return 100 * size // self.percent

    def instances(self, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For three kinds of instance: members, instance numbers, parts, differences at most."""
        band = np.frexp(np.maximum(size, 1))[1] - 1
        low = 1 << band
        top = 2 * low - 1
        yield (size > 0, 2 * band, *self._bounds(2 * top, size + np.minimum(self.largest(size), top)))
        # across the border above: this set is the smaller one
        yield (
            (size > 0) & (self.largest(size) > top),
            2 * band + 1,
            *self._bounds(top + self.largest(top), size + self.largest(size)),
        )
        # across the border below: this set is the larger one
        below = low - 1
        partner = np.minimum(below, size)
        yield (
            (size > 1) & (self.largest(below) >= size),
            2 * band - 1,
            *self._bounds(below + self.largest(below), size + partner),
        )

    def _bounds(self, most: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.differences(most)
        parts = np.where(k > 0, k + 2 + k // 12, 0)  # without differences equal sets are one node
        return parts, np.minimum(self.differences(mine), k)


def signatures(size: np.ndarray, rows: np.ndarray, values: np.ndarray, scheme: Scheme):
    """signature, row, margin of each instance's sets.

    ``margin`` is how many parts that aren't empty a similar pair must agree on.
    """
    high = values >> np.uint64(32)
    spread = mix(values + np.uint64(0x1234567))
    for member, number, parts, most in scheme.instances(size):
        member = member & (parts > 0)
        if not member.any():
            continue
        mine = member[rows]
        r, h, c = rows[mine], high[mine], spread[mine]
        # parts are ranges of hashes, so sorted shingles are sorted by part
        part = ((h * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (part[1:] != part[:-1])))
        content = np.add.reduceat(c, heads)
        r, part = r[heads], part[heads]
        filled = np.bincount(r, minlength=len(size))
        margin = parts - most - (parts - filled)
        yield _sign(content, number[r], part), r, margin[r]
        for row in np.flatnonzero(member & (margin <= 0)):
            empty = np.setdiff1d(np.arange(parts[row]), part[r == row])
            yield _sign(np.zeros(len(empty), np.uint64), np.full(len(empty), number[row]), empty), np.full(len(empty), row), np.full(len(empty), margin[row])


def _sign(content: np.ndarray, number: np.ndarray, part: np.ndarray) -> np.ndarray:
    return mix(mix(content) ^ mix((number.astype(np.uint64) << np.uint64(32)) + part.astype(np.uint64) + np.uint64(1)))


def _signature_rows(k: int, scheme: Scheme, clashing: np.ndarray):
    """key, node, sig, info rows.  ``info`` is twice the margin.

    Signatures of more than ``CROWD`` sets of a batch are marked (info odd) by one of them; the
    others name the signature in ``sig`` and travel under a key of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # signatures take several times the memory of their texts, so a batch is taken in parts
        for batch in (whole.slice(at, SIGNED_ROWS) for whole in batches for at in range(0, whole.num_rows, SIGNED_ROWS)):
            found, seen = [], set()
            for part in slices(batch.column(0)):
                size, key, _, rows, values = sizes_and_keys(part, k, clashing, checked=False)
                # equal sets of a batch sign once
                fresh = np.zeros(part.rows, bool)
                for row, node in enumerate(key.tolist()):
                    if size[row] and node not in seen:
                        seen.add(node)
                        fresh[row] = True
                size = np.where(fresh, size, 0)
                mine = fresh[rows]
                for sig, row, margin in signatures(size, rows[mine], values[mine], scheme):
                    found.append((sig, key[row], margin))
            if not found:
                continue
            sig, node, margin = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.argsort(sig)
            s = sig[order]
            heads = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
            count = np.diff(np.append(heads, len(s)))
            info, name, send = 2 * np.maximum(margin, -1), np.zeros(len(sig), np.uint64), sig.copy()
            for head, n in zip(heads[count > CROWD], count[count > CROWD], strict=True):
                crowd = order[head : head + n]
                info[crowd[0]] += 1
                name[crowd[1:]] = sig[crowd[1:]]
                send[crowd[1:]] = mix(node[crowd[1:]] ^ sig[crowd[1:]])
            columns = [send.view(np.int64), node.view(np.int64), name.view(np.int64), info.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "sig", "info"])

    return run


# ----------------------------------------------------------------------- join


def set_table(docs: DataFrame, k: int = SHINGLE, clashing: np.ndarray = _NONE) -> DataFrame:
    """id, twin, n_shingles, node, check, sketch of every row; ``node`` names the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                size, key, check, rows, values = sizes_and_keys(part, k, clashing)
                columns = [batch.column(i).slice(part.first, part.rows) for i in range(2)]
                columns += [pa.array(size.astype(np.int64)), pa.array(key.view(np.int64)), pa.array(check.view(np.int64))]
                columns.append(pa.array(parity_sketches(size, rows, values), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "twin", "n_shingles", "node", "check", "sketch"])

    return _texts(docs).mapInArrow(run, "id long, twin long, n_shingles long, node long, check long, sketch binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col(ID).cast("long").alias("id"), F.xxhash64("text").alias("twin"), "text")


def grouped_rows(signed: DataFrame) -> DataFrame:
    """sig, node, margin, others of all rows that share a signature.

    ``others`` are the nodes before it in a small group, and null in a large one.
    """
    group = Window.partitionBy("key")
    met = (
        signed.repartition("key")
        .withColumn("n", F.count("*").over(group))
        .withColumn("marked", F.max(F.col("info") % 2 != 0).over(group))
        .filter((F.col("n") > 1) | F.col("marked") | (F.col("sig") != 0))
    )
    large = (F.col("n") > SMALL) | F.col("marked") | (F.col("sig") != 0)
    earlier = Window.partitionBy("key").orderBy("node").rowsBetween(-SMALL, -1)
    return met.withColumn("before", F.collect_list("node").over(earlier)).select(
        F.when(F.col("sig") != 0, F.col("sig")).otherwise(F.col("key")).alias("sig"),
        "node",
        F.floor(F.col("info") / 2).cast("int").alias("margin"),
        F.when(~large, F.col("before")).alias("others"),
    )


def sketch_pairs(pairs: DataFrame, sketched: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    side = lambda c: sketched.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = (batch.column(c).to_numpy() for c in (2, 3))
            fits = scheme.percent * np.maximum(size_a, size_b) <= 100 * np.minimum(size_a, size_b)
            rows = np.flatnonzero(fits)
            most = scheme.differences(size_a + size_b)
            one, other = (batch.column(c).take(pa.array(rows)).to_pylist() for c in (4, 5))
            fits[rows] = [int(least_differences([x], [y])[0, 0]) <= most[r] for r, x, y in zip(rows, one, other, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return both.mapInArrow(run, "a long, b long")


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text: one document's text for each wanted node."""
    wanted = few_tasks(settle(wanted.distinct().join(nodes, "node").select("node", "id", "twin")))
    few = wanted.count() <= BROADCAST_NODES
    texts = _texts(docs).join(F.broadcast(wanted) if few else wanted, ["id", "twin"]).select("node", "text")
    return settle(texts.dropDuplicates(["node"]))


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by hashes that have nothing to do with those that made the pairs."""
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for column in (2, 3):
                of: list[np.ndarray] = []
                for part in slices(batch.column(column)):
                    rows, values = shingles(part, k, 2)
                    of += np.split(values, np.searchsorted(rows, np.arange(1, part.rows)))
                sets.append(of)
            linked = [_similar(a, b, percent) for a, b in zip(*sets, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return settle(both.mapInArrow(run, "a long, b long"))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    shared = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


# ------------------------------------------------------------------- sketches


def parity_sketches(size: np.ndarray, rows: np.ndarray, values: np.ndarray) -> list[bytes]:
    """Sketch of every set: which bits an odd number of its shingles falls on.

    A sketch has two to four bits for each shingle; halves of a longer one, laid over each
    other, are the shorter one.
    """
    bits = 4 << np.frexp(np.maximum(size, 16))[1].astype(np.int64) - 1
    start = np.concatenate([[0], np.cumsum(bits)])
    at = start[rows] + (mix(values + _GOLD) % bits[rows].astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=start[-1]) & 1).astype(np.uint8))
    return [odd[a // 8 : b // 8].tobytes() for a, b in zip(start[:-1], start[1:], strict=True)]


def least_differences(sketches: list[bytes], others: list[bytes]) -> np.ndarray:
    """For each pair, bits in which the sketches differ, at the length of the shorter one."""
    out = np.zeros((len(sketches), len(others)), np.int64)
    lengths = [np.array([len(s) for s in of]) for of in (sketches, others)]
    packed: list[dict[int, np.ndarray]] = []
    for of, length in zip((sketches, others), lengths, strict=True):
        by_length = {}
        for n in np.unique(length):
            raw = b"".join(s for s in of if len(s) == n)
            by_length[int(n)] = np.frombuffer(raw, np.uint64).reshape(-1, n // 8)
        packed.append(by_length)
    for n, a in packed[0].items():
        for m, b in packed[1].items():
            x, y = _fold(a, min(n, m) // 8), _fold(b, min(n, m) // 8)
            rows = np.flatnonzero(lengths[0] == n)
            columns = np.flatnonzero(lengths[1] == m)
            for i, r in enumerate(rows):
                out[r, columns] = np.bitwise_count(y ^ x[i]).sum(axis=1)
    return out


def _fold(sketch: np.ndarray, words: int) -> np.ndarray:
    while sketch.shape[1] > words:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _block_pairs(scheme: Scheme, every: bool):
    """Pairs of two blocks (or of one with itself) that the sketches don't rule out.

    Only sets of different components count.  Unless ``every``, of each two components the
    pair with the fewest differing bits is enough.
    """

    def run(table: pa.Table) -> pa.Table:
        block = table["block"].to_numpy()
        first = np.flatnonzero(block == block.min())
        second = np.flatnonzero(block == block.max())
        size, node, label = (table[c].to_numpy() for c in ("size", "node", "label"))
        sketch = table["sketch"].to_pylist()
        total = size[first][:, None] + size[second][None, :]
        fits = label[first][:, None] != label[second][None, :]
        fits &= scheme.percent * np.maximum(size[first][:, None], size[second][None, :]) <= 100 * np.minimum(size[first][:, None], size[second][None, :])
        if block.min() == block.max():
            fits &= node[first][:, None] < node[second][None, :]
        pairs = np.zeros((0, 2), np.int64)
        if fits.any():
            apart = least_differences([sketch[i] for i in first], [sketch[i] for i in second])
            fits &= apart <= scheme.differences(total)
            i, j = np.nonzero(fits)
            i_label, j_label, gap = label[first[i]], label[second[j]], apart[i, j]
            if not every and len(i):
                order = np.lexsort((gap, np.maximum(i_label, j_label), np.minimum(i_label, j_label)))
                lo, hi = np.minimum(i_label, j_label)[order], np.maximum(i_label, j_label)[order]
                order = order[np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))]
                i, j = i[order], j[order]
            pairs = np.stack([node[first[i]], node[second[j]]], axis=1)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return run


def family_pairs(sketched: DataFrame, families: DataFrame, labels: DataFrame, scheme: Scheme, every: bool) -> DataFrame:
    """Candidate pairs (a, b) of different components within families that have several.

    Blocks are drawn by a hash of the node; each set goes to every pair of blocks that holds
    its own, so a task holds two blocks whatever the size of the family.
    """
    rows = families.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = rows.groupBy("family").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (
        rows.join(mixed.select("family", blocks.alias("blocks")), "family")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(sketched, "node")
    )
    keys = [F.col("family"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    return placed.select(*keys, "block", "node", "label", "size", "sketch").groupBy("family", "low", "high").applyInArrow(_block_pairs(scheme, every), "a long, b long")


def link_sets(docs: DataFrame, nodes: DataFrame, k: int, percent: int, clashing: np.ndarray = _NONE) -> DataFrame:
    """node, label: components of all nodes that have a link to another.

    ``nodes`` has node, id, twin, size and sketch.
    """
    scheme = Scheme(percent)
    sketched = nodes.select("node", "size", "sketch")
    signed = docs.select("text").mapInArrow(_signature_rows(k, scheme, clashing), "key long, node long, sig long, info int")
    grouped = settle(grouped_rows(signed))
    pairs = _ordered(grouped.filter("size(others) > 0").select(F.explode("others").alias("a"), F.col("node").alias("b")))
    crowded = grouped.filter("others IS NULL").select("sig", "node", "margin").distinct()
    # a set whose similar partners must also meet it in a small group has met them
    met_all = crowded.groupBy("node").agg(F.count("*").alias("crowds"), F.min("margin").alias("margin")).filter("margin > crowds")
    open_ = crowded.join(met_all.select("node"), "node", "left_anti").select("sig", "node")
    heads = open_.groupBy("sig").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).getField("node").alias("head"))
    stars = few_tasks(settle(_ordered(open_.join(heads, "sig").select(F.col("head").alias("a"), F.col("node").alias("b")))))

    def similar(candidates: DataFrame) -> DataFrame:
        candidates = few_tasks(settle(candidates))
        ends = candidates.select(F.col("a").alias("node")).unionByName(candidates.select(F.col("b").alias("node")))
        return few_tasks(verify(candidates, texts_of(ends, nodes, docs), k, percent))

    links = similar(sketch_pairs(pairs.unionByName(stars).distinct(), sketched, scheme))
    labels = few_tasks(settle(connected_components(links)))
    if stars.isEmpty():
        return labels
    families = few_tasks(settle(connected_components(stars).withColumnRenamed("label", "family")))
    for every in (False, True):
        links = similar(_ordered(family_pairs(sketched, families, labels, scheme, every)))
        if not links.isEmpty():
            labels = few_tasks(settle(_merged(labels, links)))
    return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links, which are few: components of the components they join."""
    name = lambda c: F.coalesce(F.col(f"label_{c}"), F.col(c)).alias(c)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(name("a"), name("b"))
    joined = settle(connected_components(between)).select(F.col("node").alias("label"), F.col("label").alias("into"))
    known = labels.join(joined, "label", "left").select("node", F.coalesce("into", "label").alias("label"))
    fresh_nodes = joined.join(labels, joined["label"] == labels["node"], "left_anti").select(F.col("label").alias("node"), F.col("into").alias("label"))
    return known.unionByName(fresh_nodes)


def labelled_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row's id, twin, n_shingles and node; and for each node its least row, and its component."""
    named = docs.select(ID, "text").filter(F.col(ID).isNotNull())
    clashing = _NONE
    while True:
        table = settle(set_table(docs.select(ID, "text"), k, clashing))
        present = table.filter("id IS NOT NULL AND n_shingles > 0")
        nodes = present.groupBy("node").agg(
            F.min(F.struct("id", "twin")).alias("least"),
            F.min("check").alias("lo"),
            F.max("check").alias("hi"),
            F.first("n_shingles").alias("size"),
            F.first("sketch").alias("sketch"),
        )
        clash = F.col("lo") != F.col("hi")
        nodes = settle(nodes.select("node", F.col("least.id").alias("id"), F.col("least.twin").alias("twin"), "size", "sketch", clash.alias("clash")))
        # names that chance gave to two sets: of 10^11 sets a few hundred
        more = [r.node % (1 << 64) for r in nodes.filter("clash").select("node").collect()]
        if not more:
            break
        clashing = np.unique(np.concatenate([clashing, np.array(more, np.uint64)]))
    labels = link_sets(named, nodes.drop("clash"), k, percent, clashing)
    of_node = nodes.select("node", "id", "twin").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return table, of_node


def near_components(docs: DataFrame, k: int = SHINGLE, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, text_id of every row.

    Two documents link when their sets of ``k``-word shingles (A to Z lower-cased) have a Jaccard
    similarity of ``percent`` of 100 or more; component_id is the smallest id that links reach.
    text_id is the smallest id with the same set.  A null text, or one without words, has an
    empty set and is linked with nothing; one with fewer than ``k`` words has its whole
    sequence as its set.  Rows without an id are linked with nothing and have no component.
    Rows that repeat an id are linked if their texts are.  An empty table gives no rows.
    """
    kind = dict(docs.dtypes)[ID]
    table, of_node = labelled_sets(docs, k, percent)
    least = of_node.groupBy("label").agg(F.min("id").alias("component_id"))
    of_node = of_node.join(least, "label").select("node", F.col("id").alias("text_id"), "component_id")
    result = table.join(of_node, (table["node"] == of_node["node"]) & table["id"].isNotNull() & (table["n_shingles"] > 0), "left")
    own = lambda c: F.coalesce(F.col(c), F.col("id")).cast(kind).alias(c)
    return result.select(F.col("id").cast(kind).alias(ID), "n_shingles", own("component_id"), own("text_id"))


def near_dedup(docs: DataFrame, k: int = SHINGLE, percent: int = 80) -> DataFrame:
    """``docs`` without near-duplicates: of each component the text of the smallest id stays.

    Rows without an id and rows without words stay.
    """
    table, of_node = labelled_sets(docs, k, percent)
    keeper = of_node.groupBy("label").agg(F.min(F.struct("id", "twin")).alias("keeper"))
    rows = table.filter("id IS NOT NULL AND n_shingles > 0").join(of_node.select("node", "label"), "node").join(keeper, "label")
    losers = rows.filter("id <> keeper.id OR twin <> keeper.twin").select(F.col("id").alias("_id"), F.col("twin").alias("_twin")).distinct()
    twin = fresh(docs, "twin")
    keyed = docs.withColumn(twin, F.xxhash64("text"))
    return keyed.join(losers, (keyed[ID].cast("long") == losers["_id"]) & (keyed[twin] == losers["_twin"]), "left_anti").drop(twin)
