"""Ordered operators against plain event-by-event replays on small random sequences."""

import gzip
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline.operators.batching import _entries, assign_batches, retain_latest, sample_batches
from plumbline.operators import dedup
from plumbline.operators.dedup import find_duplicates
from plumbline.operators.envelope import encode_batches, write_bodies
from plumbline.operators.identity import assign_stream_id, backfill_unknown_stream
from plumbline.operators.ordered import carry_last

START = 1704067200000


def events(spark, rows):
    """(uid, client, ms, source, params) rows as events."""
    data = [(u, c, "x", m, s, p) for u, c, m, s, p in rows]
    df = spark.createDataFrame(data, "uid string, client_id string, event_name string, ms long, source string, params string")
    return df.select("uid", "client_id", "event_name", F.timestamp_millis("ms").alias("ts"), "source",
                     F.when(F.col("source") != "schema", F.concat(F.lit('{"k":'), "params", F.lit("}"))).alias("props"),
                     F.concat(F.lit("shape"), F.col("params")).alias("shape"))


def replay_dedup(rows):
    dups, pending = set(), defaultdict(list)
    for uid, client, ms, source, params in sorted(rows, key=lambda r: (r[2], r[0])):
        live = pending[client] = [p for p in pending[client] if ms - p[1] <= 300]
        if source == "schema":
            hit = next((p for p in live if p[2] == "codegen" and p[3] == params), None)
            if hit:
                dups.add(uid)
                live.remove(hit)
        elif any(p[2] != source and p[3] == params for p in live):
            dups.add(uid)
            pending[client] = []
        else:
            live.append((uid, ms, source, params))
    return dups


@pytest.mark.parametrize("sources", [["manual", "codegen"], ["manual", "codegen", "schema"]])
def test_dedup(spark, sources):
    draw = random.Random(7)
    rows, ms = [], START + 59_000
    for i in range(1500):
        ms += draw.choice([0, 1, 50, 100, 150, 299, 300, 301, 900])
        rows.append((f"{i:05d}", f"c{i % 3}", ms, draw.choice(sources), draw.choice("12")))
    found = {r[0] for r in find_duplicates(events(spark, rows), schema="shape" if "schema" in sources else None).collect()}
    assert found == replay_dedup(rows) and found


def test_dedup_edges(spark):
    rows = [("1", "c", START, "codegen", "1"), ("2", "c", START + 300, "manual", "1"), ("3", "c", START + 301, "codegen", "1"),
            ("4", "d", START, "codegen", "1"), ("5", "d", START + 301, "manual", "1"), ("6", "e", START, "manual", "1"), ("7", "e", START + 1, "manual", "1")]
    assert [r[0] for r in find_duplicates(events(spark, rows)).collect()] == ["2"]


def test_identity(spark):
    draw, hour = random.Random(3), 3_600_000
    rows, ms = [], START
    for i in range(1200):
        ms += draw.choice([0, 1000, hour, 2 * hour, 2 * hour + 1, 3 * hour])
        rows.append((f"{i:05d}", f"c{i % 4 // 3}", ms, "manual", "1"))
    expected, state = {}, {}
    for uid, client, ms, *_ in rows:
        created, last = state.get(client, (None, None))
        if created is None or (ms - created > 4 * hour and ms - last > 2 * hour):
            created = ms
        state[client] = (created, ms)
        expected[uid] = (client, created)
    ids = dict(assign_stream_id(events(spark, rows)).select("uid", "stream_id").collect())
    groups = defaultdict(set)
    for uid, identity in expected.items():
        groups[identity].add(ids[uid])
    assert all(len(g) == 1 for g in groups.values()) and len(set(ids.values())) == len(groups)
    nobody = events(spark, [("1", None, START, "manual", "1")])
    assert assign_stream_id(nobody).first()["stream_id"] == "unknown"


@pytest.mark.parametrize("size, seconds, gaps", [(5, 30, [1, 5, 29, 30, 31]), (4, 2, [0, 1, 1, 1]), (7, 1, [0, 0, 0.3, 0.9]), (1, 5, [1, 9]), (30, 3, [0.1, 1])])
def test_batches(spark, size, seconds, gaps):
    draw = random.Random(size)
    rows, ms = [], START + 123
    for i in range(1500):
        ms += int(draw.choice(gaps) * 1000)
        rows.append((f"{i:05d}", f"c{draw.choice([0, 0, 0, 1])}", ms, "manual", "1"))
    expected, state = {}, {}
    for uid, client, ms, *_ in rows:
        waiting, flushed, last = state.get(client, (0, ms, "start"))
        waiting += 1
        flush = waiting % size == 0 or ms - flushed >= seconds * 1000
        expected[uid] = (f"{client}|{last}", flush)
        state[client] = (0, ms, uid) if flush else (waiting, flushed, last)
    found = {r["uid"]: (r["batch_id"], r["flush"]) for r in assign_batches(events(spark, rows), size, seconds).collect()}
    assert found == expected
    with pytest.raises(ValueError):
        assign_batches(events(spark, rows), 0)


def test_retention_backfill_and_sampling(spark):
    rows = [(f"{i:05d}", "c", START + i, "manual", "1") for i in range(1002)]
    kept = [r["uid"] for r in retain_latest(events(spark, rows)).select("uid").collect()]
    assert len(kept) == 1000 and min(kept) == "00002"
    data = [("b1", 1, "s1"), ("b1", 2, "unknown"), ("b1", 3, "s2"), ("b2", 1, "unknown")]
    df = spark.createDataFrame(data, "batch_id string, n int, stream_id string").withColumn("current_stream_id", F.lit("now"))
    out = [r["stream_id"] for r in backfill_unknown_stream(df, order=["n"]).orderBy("batch_id", "n").collect()]
    assert out == ["s1", "s2", "s2", "now"]
    batches = spark.range(4000).select(F.col("id").cast("string").alias("batch_id"))
    assert sample_batches(batches, F.lit(1.0)).count() == 4000 and sample_batches(batches, F.lit(0.0)).count() == 0
    assert 1100 < sample_batches(batches, F.lit(0.3)).count() < 1300


def test_written_bodies(spark, tmp_path):
    rows = [(b, i, f'{{"é":"{"x" * (300 if b == "long" else 3)}"}}') for b in ("long", "short") for i in range(5)]
    df = spark.createDataFrame(rows, "batch_id string, n int, body string")
    write_bodies(encode_batches(df, order=["n"]), str(tmp_path))
    plain = "".join(p.read_text() for p in Path(tmp_path, "plain").glob("*.txt"))
    packed = "".join(gzip.decompress(p.read_bytes()).decode() for p in Path(tmp_path, "gzip").glob("*.gz"))
    expected = lambda b: "[" + ",".join(r[2] for r in rows if r[0] == b) + "]\n"
    assert plain == expected("short") and packed == expected("long")


def test_carry_last_both_ways(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), i * 700, i, draw.choice([None, None, None, i])) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ms long, i int, v int")
    for backward in (False, True):
        out = {r["i"]: r["w"] for r in carry_last(df, ["k"], "ms", ["ms", "i"], "v", "w", width_ms=5000, backward=backward, include_current=False).collect()}
        seen = {}
        for k, _, i, v in rows[::-1] if backward else rows:
            assert out[i] == seen.get(k)
            seen[k] = v if v is not None else seen.get(k)


def test_batches_of_a_client_that_never_pauses(spark):
    """Two thousand blocks of one client, which are put together in two levels, then a silence of an hour and more."""
    draw, ms, rows = random.Random(6), START, []
    for i in range(40_000):
        ms += draw.choice([100, 500, 900, 999]) if i != 30_000 else 3_600_000
        rows.append((f"u{i:06d}", "c", ms))
    df = spark.createDataFrame(rows, "uid string, client_id string, ms long").withColumn("ts", F.timestamp_millis("ms"))
    waiting, flushed_ms, flushed, want = 0, rows[0][2], "start", {}
    for uid, _, at in rows:
        waiting += 1
        flush = waiting % 7 == 0 or at - flushed_ms >= 1000
        want[uid] = (f"c|{flushed}", flush)
        if flush:
            waiting, flushed_ms, flushed = 0, at, uid
    got = {r.uid: (r.batch_id, r.flush) for r in assign_batches(df, 7, 1).collect()}
    assert got == want


def test_entries_of_a_long_chain(spark):
    """A hundred thousand blocks: each group of 64 is one row, so no task reads them all."""
    draw = random.Random(9)
    steps = [("c", k, [draw.randrange(5) for _ in range(5 if k else 1)]) for k in range(100_000)]
    at, want = 0, []
    for _, _, exits in steps:
        want.append(at)
        at = exits[at]
    df = spark.createDataFrame(steps + [("d", 0, [3]), ("d", 1, [0, 1, 2, 4])], "_client string, block long, exits array<int>")
    df = df.withColumn("stretch", F.struct(F.lit(1).alias("ms"), F.lit(None).cast("string").alias("uid"), F.lit(1).alias("copy")))
    got = _entries(df).collect()
    assert [r.entry for r in sorted((r for r in got if r._client == "c"), key=lambda r: r.block)] == want
    assert sorted((r.block, r.entry) for r in got if r._client == "d") == [(0, 0), (1, 3)]


@pytest.mark.parametrize("run_up", [3000, 1])
def test_a_burst_that_never_pauses(spark, monkeypatch, run_up):
    """Five minutes without a pause, in blocks; with hardly a run-up many blocks are entered wrongly at first."""
    monkeypatch.setattr(dedup, "_RUN_UP_MS", run_up)
    draw, ms, rows = random.Random(12), START + 59_000, []
    for i in range(4000):
        ms += draw.choice([0, 20, 90, 180])
        rows.append((f"{i:05d}", "c", ms, draw.choice(["manual", "codegen", "schema"]), draw.choice("1123")))
    found = {r[0] for r in find_duplicates(events(spark, rows), schema="shape").collect()}
    assert found == replay_dedup(rows) and len(found) > 500
