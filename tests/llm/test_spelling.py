"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.llm import spelling
from plumbline.llm.spelling import chunks, entries, spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def brute(rows, min_length=5, min_count=3):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    of = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(of[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(of[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def variants(word, rng):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abeé") + word[at:], word[:at] + rng.choice("abeß") + word[at + 1 :]])


def fixture(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéü") for _ in range(rng.randrange(4, 9))) for _ in range(25)] + ["aaaaa", "hello", "committee", "×÷×÷ÿ"]
    pool = base + [variants(w, rng) for w in base for _ in range(4)]
    pool += [variants(w, rng) for w in pool if len(w) > 1]
    rows = []
    for i in range(80):
        words = [rng.choice(pool[: rng.randrange(5, len(pool))]) for _ in range(rng.randrange(120))]
        rows.append((i, "".join(w.upper() + rng.choice(" ,\nĀ$1") if rng.random() < 0.2 else w + " " for w in words)))
    long = "".join(rng.choice("ab") for _ in range(200))
    for w in (long, long[:100] + long[101:], long[:64], long[:63], long[:65], long[:63] + "c", long[:62], long[:64] + "c", "b" * 3000, "b" * 3001):
        rows += [(1000 + len(rows), w)] * rng.randrange(3, 9)
    rows += [(None, "hello " * 40), (2000, None), (2001, ""), (2002, "committe " * 30_000 + "x" * 50_000), (2003, "$$ a b 12345")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_variants_equal_brute_force(documents, seed):
    rows = fixture(seed)
    docs = documents(rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("number", F.lit(2)).repartition(4)
    got = sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(docs).collect()), key=lambda r: r[0])
    assert got == brute(rows)


def test_fingerprinted_rotations_group_like_written_ones(monkeypatch):
    words = ["hello", "hallo", "helo", "helllo", "ahello", "helloa", "jello", "other"]

    def groups():
        found = {}
        for w in words:
            for key, kind in entries(w, (123_457, 987_643)):
                found.setdefault(key, set()).add((w, kind))
        return sorted(sorted(g) for g in found.values())

    written = groups()
    monkeypatch.setattr(spelling, "SPELLED", 6)  # some rotations of a word are written, others not
    assert groups() == written
    monkeypatch.setattr(spelling, "SPELLED", 0)
    assert groups() == written


def test_chains_of_forms_lead_to_their_root(documents):
    counts = {"words": 3, "wordsa": 6, "wordsab": 13, "wordsabc": 27, "wordsabcd": 60, "wordsabcde": 121, "wordsabcdef": 250}
    got = {r.word: r for r in spelling_variants(documents([(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())])).collect()}
    want = {r[0]: r for r in brute([(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())])}
    assert {w: r.root for w, r in got.items()} == {w: r[2] for w, r in want.items()}
    assert got["words"].root == "wordsabcdef"


def test_chunks_cut_no_run():
    text = "aaa bbb " + "c" * 30 + " d"
    assert "".join(chunks(text, 5)) == text
    assert [r for c in chunks(text, 5) for r in spelling.RUN.findall(c)] == spelling.RUN.findall(text)


def test_spelling_of_an_empty_table(documents):
    assert spelling_variants(documents([])).collect() == []
    assert spelling_variants(documents([(1, "a b c"), (2, None)])).collect() == []
