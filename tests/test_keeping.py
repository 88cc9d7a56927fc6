"""Rows, values and declarations that must not get lost or multiplied."""

import json
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.catalog.inputs import prop, wire
from plumbline.functions.patterns import to_java
from plumbline.operators.batching import assign_batches, count_batches, requeue_failed, retain_latest
from plumbline.operators.dedup import dedup_events
from plumbline.operators.envelope import App
from plumbline.operators.lookup import lookup_spec, spec_asof
from plumbline.plans.inspect import inspect_raw, production_profile
from plumbline.sources.specs import explode_constraints, load_specs, read_specs, skipped_patterns

START = 1704067200000


def queue(spark, rows):
    return spark.createDataFrame(rows, "uid string, client_id string, ms long").withColumn("ts", F.timestamp_millis("ms"))


def test_specifications_of_ten_levels(spark):
    children = {"leaf": prop(p={"deep": ["e", "v1"]}, minmax={"7,": ["v2"]})}
    for depth in range(9, 0, -1):
        children = {f"n{depth}": prop(children=children, v={f'["{depth}"]': ["v1"]})}
    specs = read_specs(spark.createDataFrame([("click", wire(children))], "event_name string, spec_json string"))
    rows = explode_constraints(specs, ["event_name"]).collect()
    steps = [f"n{d}" for d in range(1, 10)]
    want = {(tuple(steps[:d]), "allowed", f'["{d}"]', "v1") for d in range(1, 10)}
    leaf = (*steps, "leaf")
    want |= {(leaf, "pinned", "deep", "e"), (leaf, "pinned", "deep", "v1"), (leaf, "minmax", "7,", "v2")}
    assert {(tuple(r.path), r.kind, r.key, r.event_id) for r in rows} == want
    assert {r.depth for r in rows} == set(range(10)) and {r.base_event_id for r in rows} == {"e"}


def test_batches_keep_every_row(spark):
    rows = [(f"u{i % 7}" if i % 5 else None, None if i % 3 == 0 else f"c{i % 3}", START + 1000 * (i // 4)) for i in range(90)]
    got = assign_batches(queue(spark, rows), 4, 30).collect()
    assert Counter((r.uid, r.client_id, r.ms) for r in got) == Counter(rows)
    sizes = Counter(r.batch_id for r in got)
    assert max(sizes.values()) <= 4 and sum(r.flush for r in got) >= 3 * (len(rows) // 3 // 4)
    assert {r.batch_id.split("|")[0] for r in got if r.client_id is None} == {"unknown"}
    assert len({(r.batch_id, r.client_id) for r in got}) == len(sizes)


def test_ranks_keep_every_row(spark):
    rows = [(f"u{i:05d}", None if i % 2 else "c", START + 400_000 * (i // 3)) for i in range(2600)]
    got = Counter(r.client_id for r in retain_latest(queue(spark, rows), 1100).collect())
    assert got == {None: 1100, "c": 1100}
    newest = {r.uid for r in retain_latest(queue(spark, rows), 1100).filter("client_id = 'c'").collect()}
    assert newest == {u for u, c, _ in sorted((r for r in rows if r[1]), key=lambda r: (r[2], r[0]))[-1100:]}
    numbers = {r.uid: r.batch_no for r in count_batches(queue(spark, rows), 100).collect()}
    for client in (None, "c"):
        order = sorted((r for r in rows if r[1] == client), key=lambda r: (r[2], r[0]))
        assert all(numbers[u] == i // 100 for i, (u, _, _) in enumerate(order))


def test_production_profile_sends_clientless_events_and_the_rate(spark):
    rows = [(f"u{i}", None if i % 4 == 0 else "c", START + i * 500) for i in range(20)]
    events = queue(spark, rows).withColumns({"props": F.lit('{"a":1}'), "event_name": F.lit("x"), "event_id": F.lit(None).cast("string"), "event_hash": F.lit(None).cast("string")})
    sent = production_profile(events, App(), rate=0.999, size=5).collect()
    bodies = [b for r in sent for b in json.loads(r.request)]
    assert len(bodies) == 20 and {b["samplingRate"] for b in bodies} == {0.999}


def test_rejects_go_to_their_own_table(spark):
    rows = [("u1", "c", START), ("u2", "c", START + 1), ("u3", "c", START + 2)]
    props = F.when(F.col("uid") == "u2", '{"a":1} oops').when(F.col("uid") == "u3", "[").otherwise('{"a":1}')
    events = queue(spark, rows).withColumns({"props": props, "event_name": F.lit("x"), "source": F.lit("manual"), "event_id": F.lit(None).cast("string"), "event_hash": F.lit(None).cast("string")})
    specs = load_specs(spark.createDataFrame([], "event_name string, spec_json string"), ["event_name"])
    inspected, rejects = inspect_raw(events, specs, App())
    assert [r.uid for r in inspected.collect()] == ["u1"] and {r.uid for r in rejects.collect()} == {"u2", "u3"}


def test_several_documents_of_one_key_are_one_lookup(spark):
    documents = [("click", wire({}, schema_id=s), at) for s, at in (("old", 1), ("zzz", 2), ("new", 3))]
    specs = spark.createDataFrame(documents, "event_name string, spec_json string, at int")
    events = spark.createDataFrame([("u1", "click"), ("u2", "view")], "uid string, event_name string")
    found = lookup_spec(events, load_specs(specs, ["event_name"], order="at")).select("uid", "metadata.schemaId").collect()
    assert sorted(map(tuple, found), key=str) == [("u1", "new"), ("u2", None)]


def test_skipped_patterns_are_listed(spark):
    document = wire({"a": prop(rx={"^[a-z]+$": ["e"], "(x+)+y": ["v1"]}), "b": prop(rx={"[": ["e"]})})
    specs = spark.createDataFrame([("click", document), ("view", wire({}))], "event_name string, spec_json string")
    assert {tuple(r) for r in skipped_patterns(specs, ["event_name"]).collect()} == {("click", "(x+)+y"), ("click", "[")}


def test_fetches_of_one_millisecond_are_ordered(spark):
    snapshots = spark.createDataFrame([("c", START, 2, None, "second"), ("c", START, 1, None, "first")], "client_id string, fetched_ms long, fetch_id long, invalid_ms long, spec string")
    found = spec_asof(queue(spark, [("u", "c", START + 5)]), snapshots.repartition(2), ["client_id"]).collect()
    assert [(r.uid, r.spec) for r in found] == [("u", "second")]


def test_requeued_bodies_lose_metadata(spark):
    body = '{"eventProperties":[{"propertyName":"a,\\"eventSpecMetadata\\":{"}],"eventId":null,"eventSpecMetadata":{"schemaId":"s"},"validatedBranchId":"b"}'
    rows = spark.createDataFrame([("u", "b1", body, "m")], "uid string, batch_id string, body string, metadata string")
    acks = rows.select("batch_id").limit(0)
    [r] = requeue_failed(rows, acks, rows.limit(0)).collect()
    assert r.metadata is None and list(json.loads(r.body)) == ["eventProperties", "eventId"]


@pytest.mark.parametrize(
    "pattern, yes, no",
    [(r"^[\\s]$", ["\\", "s"], [" ", "\u2003", "x"]), (r"^[\s]$", [" ", "\u2003"], ["s", "\\"]), (r"^[\Sx]$", ["a", "x"], [" ", "\u2003"]), (r"^[^\S]$", [" ", "\u2003"], ["a"])],
)
def test_spaces_in_classes(spark, pattern, yes, no):
    df = spark.createDataFrame([(t,) for t in yes + no], "t string")
    found = {r.t for r in df.filter(F.col("t").rlike(to_java(pattern))).collect()}
    assert found == set(yes)


def _seconds(job):
    started = time.perf_counter()
    job()
    return time.perf_counter() - started


def test_a_hot_minute_grows_in_proportion(spark):
    def reports(n):
        rows = spark.range(n).select(
            F.lpad(F.col("id").cast("string"), 8, "0").alias("uid"), F.lit("c").alias("client_id"), F.lit("x").alias("event_name"),
            F.timestamp_millis(F.lit(START) + F.floor(F.col("id") * 60_000 / n)).alias("ts"), F.lit("manual").alias("source"), F.lit('{"a":1}').alias("props"),
        )
        return rows

    def run(n):
        assert dedup_events(reports(n)).count() == n
        assert assign_batches(reports(n)).count() == n

    run(500)
    small, large = _seconds(lambda: run(4_000)), _seconds(lambda: run(32_000))
    assert large < 12 * small
