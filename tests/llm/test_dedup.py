"""Exact, substring and near dedup against brute force over small sets of documents."""

import random
from hashlib import sha256

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm.components import connected_components
from plumbline.llm.exact_dedup import ascii_lower, exact_dedup, exact_groups
from plumbline.llm.near_dedup import least_differences, near_components, near_dedup, parity_sketches, sizes_and_keys
from plumbline.llm.shared import slices
from plumbline.llm.substring_dedup import substring_dedup

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(n, seed, pool=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


# ---------------------------------------------------------------------- exact


def brute_exact(rows):
    norm = lambda t: (t or "").encode().translate(LOWER)
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        of = groups[norm(t)]
        keep = max((x for x in of if x is not None), default=None)
        out.append((i, keep, len(of), i == keep, sha256(norm(t)).hexdigest()))
    return sorted(out, key=str)


EXACT = [(5, "Same Text"), (3, "same text"), (9, "sAME tEXT"), (1, "ÄB"), (2, "äb"), (4, None), (6, ""), (7, "x" * 50_000), (8, "X" * 50_000), (None, "same text"), (None, "alone"), (3, "same text")]


def test_exact_groups_equal_brute_force(documents):
    got = exact_groups(documents(EXACT), keep="largest").collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got], key=str) == brute_exact(EXACT)


def test_exact_groups_survive_colliding_hashes(documents):
    clash = lambda normal: F.unhex(F.substring(F.md5(normal), 1, 1).cast("string"))  # 16 values
    rows = [(i, f"text {i % 40}") for i in range(120)]
    got = exact_groups(documents(rows), keep="largest", hash_of=lambda c: F.coalesce(clash(c), F.lit(b"0"))).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got], key=str) == brute_exact(rows)


def test_exact_dedup_keeps_one_row_of_each_text(documents):
    docs = documents(EXACT).withColumn("h", F.lit(1)).withColumn("__key", F.lit("own")).withColumn("keep_id", F.lit(2))
    kept = exact_dedup(docs, keep="smallest")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([3, 1, 2, 4, 7, None], key=str)


def test_exact_of_an_empty_table(documents):
    assert exact_groups(documents([])).collect() == []
    assert exact_dedup(documents([])).collect() == []


# ------------------------------------------------------------------ substring


def brute_substring(rows, window=13):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        if i is not None:
            for j in range(len(w) - window + 1):
                key = tuple(w[j : j + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def substring_fixture(seed):
    rng = random.Random(seed)
    passages = [words(rng.choice([12, 13, 14, 30, 80]), 100 + k, pool=30 if k % 2 else 400) for k in range(6)]
    rows = []
    for i in range(60):
        body = words(rng.randrange(0, 60), 1000 * seed + i)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = rng.choice(passages)
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", "  \t"]).join(body)))
    rows += [(None, " ".join(passages[4])), (2000, None), (2001, ""), (2002, "a b"), (2003, " ".join(["la"] * 4000)), (2004, " ".join(["la"] * 50))]
    return rows + [rows[0], rows[1]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substring_dedup_equals_brute_force(documents, seed):
    rows = substring_fixture(seed)
    docs = documents(rows).withColumn("spans", F.lit(1)).withColumn("id", F.lit(3)).withColumn("twin", F.lit(4)).repartition(4)
    got = substring_dedup(docs).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == brute_substring(rows)


def test_substring_repeats_are_maximal_runs(documents):
    shared = words(40, 7)
    rows = [(1, " ".join(["x1", *shared, "x2"])), (2, " ".join(["y1", "y2", *shared, "y3"]))]
    got = {r.doc_id: r for r in substring_dedup(documents(rows), with_text=True).collect()}
    assert [tuple(s) for s in got[2].repeats] == [(2, 42)] and got[2].kept_text == "y1 y2 y3"
    assert got[1].repeats == [] and got[1].n_removed == 0


def test_substring_of_an_empty_table(documents):
    assert substring_dedup(documents([])).collect() == []


# ----------------------------------------------------------------------- near


def shingle_set(text, k=5):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_near(rows, percent=80):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if None not in (rows[a][0], rows[b][0]) and sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return sorted([(i, len(s), None if i is None else least[root(a)]) for a, ((i, _), s) in enumerate(zip(rows, sets))], key=str)


def near_fixture(seed, base_words=(5, 12, 30, 90, 260), copies=14):
    rng = random.Random(seed)
    rows, i = [], 0
    for b, n in enumerate(base_words):
        base = words(n, seed * 50 + b, pool=5000)
        for _ in range(copies):
            body = list(base)
            for _ in range(rng.randrange(max(2, n // 40) + 1)):
                body[rng.randrange(n)] = f"edit{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                body = body[: -max(1, n // 12)]
            rows.append((i, " ".join(body).title() if rng.random() < 0.3 else " ".join(body)))
            i += rng.choice([1, 2])
    common = words(60, 999)
    for _ in range(25):  # a passage that unlike documents share
        rows.append((i, " ".join(words(70, seed * 7000 + i, pool=5000) + common)))
        i += 1
    rows += [(i + 1, None), (i + 2, ""), (i + 3, "one two"), (i + 4, "ONE  two"), (i + 5, "three"), (None, "one two"), (i + 3, "one two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_components_equal_brute_force(documents, seed):
    rows = near_fixture(seed)
    docs = documents(rows).withColumn("node", F.lit(1)).withColumn("twin", F.lit(2)).withColumn("id", F.lit(2)).repartition(3)
    got = near_components(docs).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_near(rows)


def test_crowds_are_linked_through_families(documents, monkeypatch):
    """Every signature of these groups is above both bounds, so only stars and blocks find the links."""
    from plumbline.llm import near_dedup as module

    monkeypatch.setattr(module, "SMALL", 2)
    monkeypatch.setattr(module, "CROWD", 3)
    monkeypatch.setattr(module, "BLOCK", 5)
    rows = near_fixture(5, base_words=(40, 120), copies=12)
    got = near_components(documents(rows).repartition(2)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute_near(rows)


def test_sketches_never_exceed_the_differences():
    rng = random.Random(3)
    texts = [" ".join(words(n, rng.random(), pool=rng.choice([20, 3000]))) for n in (3, 9, 40, 41, 130, 300, 900, 5000)]
    texts += [t + " more words at the end of it" for t in texts]
    [part] = slices(pa.array(texts))
    size, _, _, rows, values = sizes_and_keys(part, 5)
    sketch = parity_sketches(size, rows, values)
    sets = [shingle_set(t) for t in texts]
    assert size.tolist() == [len(s) for s in sets]
    bound = least_differences(sketch, sketch)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert bound[i, j] <= len(a ^ b) and (len(a ^ b) > 0.15 * len(a | b) or bound[i, j] >= 0.4 * len(a ^ b))


def test_near_dedup_keeps_one_document_of_each_component(documents):
    rows = [(i, t) for i, t in near_fixture(3) if i is not None]
    kept = near_dedup(documents(rows).withColumn("__twin", F.lit(1)))
    assert kept.columns[-1] == "__twin"
    want = {c for i, n, c in brute_near(rows)}
    assert {r.doc_id for r in kept.collect()} == want


def test_near_of_an_empty_table(documents):
    assert near_components(documents([])).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (200, 200)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200, 202: 200}


def test_only_ascii_letters_are_lowered(spark):
    assert spark.sql("SELECT 'AZÄ' AS text").select(ascii_lower("text")).first()[0] == "azÄ"
