"""Line dedup against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.line_dedup import GONE, OPEN, REPORT, kept_lines, line_dedup, scan_rows, to_bitmap

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(of := holders.get(key(x), ())) < min_docs or i == max(of)]
        out.append((i, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def fixture(seed):
    rng = random.Random(seed)
    common = [f"this line is number {k} of the common lines" for k in range(12)] + ["é" * 19, "é" * 20, "Ünïcode line of ten plus ten", "x" * 19, "y" * 20]
    rows = []
    for i in range(150):
        lines = [f"own line {i} {j} " + "w" * rng.randrange(20) for j in range(rng.randrange(4))]
        for _ in range(rng.randrange(6)):
            line = rng.choice(common)
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(["", "  ", "\t", "\r"]) + rng.choice([line, line.upper() if line.isascii() else line]) + rng.choice(["", " ", "\x0b\x0c"]))
        rows.append((rng.randrange(120), "\n".join(lines)))
    rows += [(i, "the line that every document holds\n" * (i % 3 + 1)) for i in range(200, 500)]
    rows += [(None, common[0]), (None, None), (900, None), (901, ""), (902, "\n\n"), (903, "z" * 300_000 + "\n" + common[1]), (904, "long text\n" * 40_000 + common[1])]
    # all lines of the smaller ids go
    rows += [(i, "a line that is all there is") for i in (-5, 700, 701)]
    return rows + rows[:5] + [rows[-1]] * 40


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(documents, spark, seed):
    rows = fixture(seed)
    docs = documents(rows).withColumn("keep", F.lit(1)).withColumn("line", F.lit(2)).withColumn("twin", F.lit(3)).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keys that several tasks hold
    try:
        got = line_dedup(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got], key=str) == brute(rows)


def test_line_dedup_bitmap_and_text(documents):
    rows = [(i, f"first of {i}\nthe line that they all share\nlast") for i in range(4)]
    got = {r.doc_id: r for r in line_dedup(documents(rows), with_text=True).collect()}
    assert got[0].kept_text == "first of 0\nlast" and got[3].kept_text == rows[3][1] and got[3].keep is None
    assert kept_lines(bytes(got[1].keep), 3).tolist() == [True, False, True]
    many = np.array([3, 70_000])
    assert np.flatnonzero(~kept_lines(to_bitmap(many), 100_000)).tolist() == many.tolist()


def test_scan_in_any_cut_equals_the_whole():
    """Tasks that hold any consecutive part of the order decide as one task would."""
    rng = random.Random(4)
    rows = sorted({(k, 0, -rng.randrange(6 if k else 30), 0, rng.randrange(3)) for k in (0, 0, 0, 1, 2, 3) for _ in range(12)})
    rows = [(a, b, -d, t, line) for a, b, d, t, line in rows]
    docs = {}
    for r in rows:
        docs.setdefault(r[0], set()).add(r[2])
    want = sorted(r for r in rows if len(docs[r[0]]) >= 3 and r[2] != max(docs[r[0]]))
    for trial in range(200):
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(trial % 8))
        found = [x for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True) for x in scan_rows(iter(rows[a:b]), 3)]
        known = {}
        for kind, a, _, d, _, _ in found:
            if kind == REPORT:
                known.setdefault(a, set()).add(d)
        gone = [r[1:] for r in found if r[0] == GONE]
        gone += [r[1:] for r in found if r[0] == OPEN and len(known.get(r[1], ())) >= 3 and r[3] != max(known[r[1]])]
        assert sorted(gone) == want


def test_lines_of_an_empty_table(documents):
    assert line_dedup(documents([])).collect() == []
