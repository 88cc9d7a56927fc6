"""Streams to the end: late rows, requests, changing specifications, lookups and the queue, over several micro-batches."""

import random
import tempfile
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.catalog.flow import _SECONDS, _SIZE, _asked, _queue, _reports
from plumbline.catalog.inputs import prop, same_spec, wire
from plumbline.operators.batching import assign_batches
from plumbline.operators.dedup import seen_by_codegen
from plumbline.operators.envelope import App, encode_batches, write_bodies
from plumbline.operators.lookup import branch_epochs, spec_asof
from plumbline.operators.queue import Queue, replay_queue
from plumbline.plans.inspect import inspect_events, inspect_schemas, outgoing_requests, production_profile
from plumbline.sources.specs import load_specs
from plumbline.streaming.gate import LiveSpecs, finish, gate, is_late, read_part, stream_kept
from plumbline.streaming.lookup import ANSWER_MS, branch_epochs_stream, seen_by_codegen_stream, spec_asof_stream, spec_requests_stream
from plumbline.streaming.queue import queue_stream
from plumbline.streaming.requests import READY, ready_events, ready_production, ready_schemas, request_stream, write_requests

SF = "/root/testdata/sf0.001"
START = 1704067200000


@pytest.fixture
def folder():
    return lambda name: tempfile.mkdtemp(prefix=f"plumbline-{name}-")


def parts(rows, n, column="ts"):
    """Rows in order of time, in ``n`` parts, and two later rows that move the watermark past them."""
    pdf = rows.orderBy(column).toPandas()
    cut = -(-len(pdf) // n)
    return [pdf[i * cut : (i + 1) * cut] for i in range(n)]


def feed(spark, pdf, schema, path):
    spark.createDataFrame(pdf, schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, schema, path, delay="1 second"):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("ts", delay)


def collect(stream, name, checkpoint):
    finish(stream.writeStream.format("memory").queryName(name).outputMode("append"), checkpoint)
    return stream.sparkSession.table(name)


def closed(rows, **ends):
    """Rows and, two days later, a row that closes the stream."""
    last = rows.iloc[[-1]].assign(**{k: v for k, v in ends.items() if k in rows.columns})
    return last.assign(ts=rows["ts"].max() + pd.Timedelta(days=2))


# ------------------------------------------------------------------ late rows


def test_late_rows_are_kept_apart_and_none_is_lost(spark, folder):
    """Kept and late rows and rejects are the input, batch by batch, also when a micro-batch runs again."""
    at, path, cp = folder("gate"), folder("in"), folder("cp")
    schema = "uid string, ts timestamp, props string"
    rng, seen, late, reached = random.Random(5), [], set(), None
    for k in range(4):
        rows = []
        for i in range(50):
            ms = START + k * 60_000 + rng.randrange(-150_000, 60_000)
            rows.append((f"{k}-{i}", pd.Timestamp(ms, unit="ms"), '{"a":1}' if i % 10 else "[1]"))
        rows.append((f"{k}-null", None, '{"a":1}'))
        # one row at the watermark itself, which Spark would drop as well
        if reached is not None:
            rows.append((f"{k}-edge", pd.Timestamp(reached - 60_000, unit="ms"), "{}"))
            late |= {u for u, t, p in rows if t is not None and p != "[1]" and t <= pd.Timestamp(reached - 60_000, unit="ms")}
        seen += rows
        reached = max([int(t.value // 1_000_000) for _, t, p in rows if t is not None and p != "[1]"] + ([reached] if reached else []))
        feed(spark, pd.DataFrame(rows, columns=["uid", "ts", "props"]), schema, path)
        finish(gate(source(spark, schema, path), at, "60 seconds"), cp)
    found = {p: [r.uid for r in read_part(spark, at, p, schema).collect()] for p in ("kept", "late", "rejects")}
    assert set(found["late"]) == late and len(late) > 20
    assert set(found["rejects"]) == {u for u, t, p in seen if t is None or p == "[1]"}
    assert Counter(sum(found.values(), [])) == Counter(u for u, _, _ in seen)
    # the checkpoint is lost: all micro-batches run again and write nothing
    finish(gate(source(spark, schema, path), at, "60 seconds"), folder("cp"))
    again = {p: [r.uid for r in read_part(spark, at, p, schema).collect()] for p in found}
    assert {p: Counter(v) for p, v in again.items()} == {p: Counter(v) for p, v in found.items()}
    # a stream over what was kept drops none of it
    kept = stream_kept(spark, at, schema, "60 seconds").dropDuplicatesWithinWatermark(["uid"])
    assert Counter(r.uid for r in collect(kept, "kept_rows", folder("cp")).collect()) == Counter(found["kept"])


def test_rule_of_the_gate(spark):
    rows = spark.createDataFrame([(0, START - 1000), (1, START - 999), (2, START)], "i int, ms long").withColumn("ts", F.timestamp_millis("ms"))
    assert [r.late for r in rows.orderBy("i").select(is_late(F.col("ts"), F.lit(START), "1 second").alias("late")).collect()] == [True, False, False]
    assert not rows.filter(is_late(F.col("ts"), F.lit(None).cast("long"), "1 second")).count()


# ------------------------------------------------------------------- requests


def _specs(rows):
    return load_specs(same_spec(rows, wire({"k": prop(minmax={"0,2": ["e"]})})).filter("event_name = 'click'"), ["event_name"])


def through_gate(spark, folder, rows, fields, ready, name, whole=True, rate=1.0):
    """Feed rows in parts; after each the gate and the requests run. Gives the written requests."""
    path, at, out, gate_cp, cp = (folder(x) for x in ("in", "gate", "out", "cp", "cp"))
    fed = parts(rows.select(*[c.split()[0] for c in fields.split(", ")]), 2)
    fed.append(closed(fed[-1], uid="last", client_id="nobody"))
    for part in fed:
        feed(spark, part, fields, path)
        finish(gate(source(spark, fields, path, "5 seconds"), at, "5 seconds", ready), gate_cp)
        stream = stream_kept(spark, at, READY, "5 seconds")
        finish(write_requests(request_stream(stream, _SIZE, _SECONDS, rate, whole), out), cp)
    lines = [r.value for kind in ("gzip", "plain") for r in spark.read.option("recursiveFileLookup", "true").text(f"{out}/{kind}").collect()]
    assert read_part(spark, at, "late", fields).count() == 0
    return Counter(lines)


FIELDS = "uid string, client_id string, event_name string, source string, props string, ts timestamp, event_id string, event_hash string"


def test_requests_of_an_inspection(spark, folder):
    rows = _reports(spark, SF).filter("n < 300")
    specs, app = _specs(rows), App()
    table = outgoing_requests(inspect_events(rows, specs, app), size=_SIZE, seconds=_SECONDS).collect()
    got = through_gate(spark, folder, rows, FIELDS, lambda batch: ready_events(batch, specs, app), "p1")
    # the table also has the rows behind each client's last flush, which still wait in a stream
    waiting = Counter(r.request for r in table) - got
    assert not got - Counter(r.request for r in table)
    assert len(waiting) <= rows.select("client_id").distinct().count() and sum(got.values()) > 100
    names = {r.batch_id.split("|")[0]: r for r in table if waiting[r.request]}
    assert "event" not in names and all(r.n_events < _SIZE for r in names.values())


def test_requests_of_the_production_profile(spark, folder):
    rows = _queue(spark, SF).filter("n < 400").withColumns({"source": F.lit("manual"), "event_id": F.lit(None).cast("string"), "event_hash": F.lit(None).cast("string")})
    app = App()
    table = production_profile(rows, app, rate=0.7, size=_SIZE, seconds=_SECONDS).collect()
    got = through_gate(spark, folder, rows, FIELDS, lambda batch: ready_production(batch, app, 0.7), "p4", whole=False, rate=0.7)
    assert not got - Counter(r.request for r in table)
    assert len(Counter(r.request for r in table) - got) <= 3 and sum(got.values()) > 30


def test_requests_of_ready_made_schemas(spark, folder):
    reports, asked, app = _reports(spark, SF).filter("n < 300"), _asked(spark, SF).filter("uid < '0000000300'"), App()
    kept = inspect_schemas(asked, reports, app)
    table = Counter(r.request for r in encode_batches(assign_batches(kept.select("uid", "client_id", "ts", "body"), _SIZE, _SECONDS)).collect())
    mixed = reports.withColumn("schema_json", F.lit(None).cast("string")).unionByName(
        asked.withColumns({"source": F.lit("schema"), "props": F.lit(None).cast("string")}), allowMissingColumns=True
    )
    got = through_gate(spark, folder, mixed, f"{FIELDS}, schema_json string", lambda batch: ready_schemas(batch, app), "p2")
    assert not got - table and len(table - got) <= 4 and sum(got.values()) > 20


def test_reports_without_a_client(spark, folder):
    """They double nothing and have no identity; what is not sent at once shares a queue."""
    reports = _reports(spark, SF).filter("n < 60").withColumn("client_id", F.lit(None).cast("string"))
    specs, app = _specs(reports), App()
    got = through_gate(spark, folder, reports, FIELDS, lambda batch: ready_events(batch, specs, app), "nobody")
    assert all('"streamId":"unknown"' in r for r in got)
    sizes = Counter(r.count('"messageId"') for r in got.elements())
    clicks = reports.filter("event_name = 'click'").count()
    assert sizes[1] >= clicks and sizes[_SIZE] >= (reports.count() - clicks) // _SIZE - 1


def test_a_specification_added_between_micro_batches(spark, folder):
    path, at, cp, specs_at = folder("in"), folder("gate"), folder("cp"), folder("specs")
    live = LiveSpecs(lambda: spark.read.schema("event_name string, spec_json string").parquet(specs_at), ["event_name"])
    document = wire({"a": prop(p={"1": ["e"]})})
    schema = "uid string, client_id string, event_name string, source string, props string, ts timestamp, event_id string, event_hash string"
    row = lambda uid, ms: pd.DataFrame([(uid, "c", "x", "manual", '{"a":2}', pd.Timestamp(ms, unit="ms"), None, None)], columns=[c.split()[0] for c in schema.split(", ")])
    spark.createDataFrame([("y", document)], "event_name string, spec_json string").write.mode("append").parquet(specs_at)
    writer = lambda: gate(source(spark, schema, path), at, "1 minute", lambda batch: ready_events(batch, live.current(), App()))
    feed(spark, row("before", START), schema, path)
    finish(writer(), cp)
    compiled = live.table
    feed(spark, row("same", START + 1), schema, path)
    finish(writer(), cp)
    assert live.table is compiled  # nothing changed, nothing is compiled again
    spark.createDataFrame([("x", document)], "event_name string, spec_json string").write.mode("append").parquet(specs_at)
    feed(spark, row("after", START + 2), schema, path)
    finish(writer(), cp)
    got = {r.uid: (r.route, "failedEventIds" in r.body or "passedEventIds" in r.body) for r in read_part(spark, at, "kept", READY).collect()}
    assert got == {"before": ("batch", False), "same": ("batch", False), "after": ("immediate", True)}


def test_bodies_written_twice_are_there_once(spark, folder):
    out = folder("out")
    rows = [(b, i, f'{{"x":"{"x" * (300 if b == "long" else 3)}"}}') for b in ("long", "short") for i in range(5)]
    requests = encode_batches(spark.createDataFrame(rows, "batch_id string, n int, body string"), order=["n"])
    for name in ("day-1", "day-1", "day-2"):
        write_bodies(requests, out, name)
    read = lambda kind: spark.read.option("recursiveFileLookup", "true").text(f"{out}/{kind}").count()
    assert read("gzip") == read("plain") == 2


# -------------------------------------------------------------------- lookups


def test_seen_by_codegen_on_a_stream(spark, folder):
    rows = _reports(spark, SF).filter("n < 400")
    path = folder("in")
    fields = "uid string, client_id string, source string, props string, ts timestamp"
    fed = parts(rows.select("uid", "client_id", "source", "props", "ts"), 3)
    fed += [closed(fed[-1], uid="last", source="codegen"), closed(fed[-1], uid="end", source="manual")]
    for part in fed:
        feed(spark, part, fields, path)
    read = lambda: source(spark, fields, path)
    got = collect(seen_by_codegen_stream(read().filter("source = 'manual'"), read(), F.col("props")), "seen", folder("cp"))
    want = {(r.uid, r.seen_by_codegen, r.props) for r in seen_by_codegen(rows.filter("source = 'manual'"), rows).collect()}
    assert {tuple(r) for r in got.filter("uid <> 'end'").collect()} == want
    assert 0 < sum(s for _, s, _ in want) < len(want)


def fetched(spark, n, seed):
    """Fetches of two clients and three keys whose branch changes now and then, with ties."""
    rng = random.Random(seed)
    rows, ms, branch = [], START, {"a": "main", "b": "main"}
    for i in range(n):
        ms += rng.choice([0, 1, 500, 20_000, 45_000])
        client = rng.choice("ab")
        if rng.random() < 0.1:
            branch[client] = rng.choice(["main", "dev", "x"])
        found = rng.random() < 0.8
        rows.append((client, f"k{rng.randrange(3)}", i, pd.Timestamp(ms, unit="ms"), branch[client] if found else None, f"spec {i}" if found else None))
    return pd.DataFrame(rows, columns=["client_id", "key", "fetch_id", "ts", "branch_id", "spec"]), ms


FETCH = "client_id string, key string, fetch_id long, ts timestamp, branch_id string, spec string"


def test_branches_and_freshness_on_a_stream(spark, folder):
    fetches, end = fetched(spark, 160, 2)
    rng = random.Random(3)
    events = pd.DataFrame(
        [(f"e{i:04d}", rng.choice("ab"), f"k{rng.randrange(3)}", pd.Timestamp(rng.choice([START + rng.randrange(end - START), int(rng.choice(list(fetches["ts"])).value // 1_000_000)]), unit="ms")) for i in range(600)],
        columns=["uid", "client_id", "key", "ts"],
    ).sort_values("ts")
    asks = "uid string, client_id string, key string, ts timestamp"
    at = {"fetches": folder("in"), "events": folder("in")}
    for k in range(3):
        for name, of, schema in (("fetches", fetches, FETCH), ("events", events, asks)):
            cut = -(-len(of) // 3)
            feed(spark, of[k * cut : (k + 1) * cut], schema, at[name])
    for name, of, schema in (("fetches", fetches, FETCH), ("events", events, asks)):
        last = of.iloc[[-1]].assign(client_id="nobody", ts=of["ts"].max() + pd.Timedelta(days=2))
        feed(spark, last, schema, at[name])
        feed(spark, last, schema, at[name])
    # the two inputs are cut at other times, so one waits for the other
    read = lambda name, schema: source(spark, schema, at[name], "1 hour")
    told = spark.createDataFrame(fetches, FETCH).withColumn("fetched_at", F.col("ts"))
    epochs = branch_epochs(told, ["client_id"])
    got = collect(branch_epochs_stream(read("fetches", FETCH), ["client_id"]), "epochs", folder("cp"))
    columns = ["fetch_id", "fetched_ms", "branch_id", "branch_changed", "epoch_ms"]
    want = {tuple(r) for r in epochs.select(*columns).collect()}
    assert {tuple(r) for r in got.select(*columns).collect()} - want <= {tuple(r) for r in got.filter(F.col("fetched_ms") > end).collect()}
    assert want <= {tuple(r) for r in got.select(*columns).collect()} and any(r[3] for r in want)
    asof = collect(spec_asof_stream(read("events", asks), read("fetches", FETCH), ["client_id"], ["key"]), "asof", folder("cp"))
    table = spec_asof(spark.createDataFrame(events, asks), epochs, ["client_id", "key"])
    want = {(r.uid, r.spec_state, r.spec) for r in table.collect()}
    assert {tuple(r) for r in asof.collect() if tuple(r) in want or r.uid in {u for u, _, _ in want}} >= want
    assert Counter(s for _, s, _ in want).keys() == {"hit", "absent", "miss"}


def test_a_specification_is_asked_for_once_while_open(spark, folder):
    rng = random.Random(7)
    events = sorted((START + rng.randrange(200_000), f"e{i:04d}", f"k{rng.randrange(4)}") for i in range(400))
    # replayed by hand: an answer comes after half a second, but one in three requests is never answered
    asked, loaded, answers, want, due = {}, {}, [], [], []
    for ms, _, key in events:
        for d in sorted(x for x in due if x[0] <= ms):
            loaded[d[1]], asked[d[1]] = d[0], None
            due.remove(d)
        if key in loaded and ms - loaded[key] <= 60_000:
            continue
        if asked.get(key) is not None and ms - asked[key] <= ANSWER_MS:
            continue
        asked[key] = ms
        want.append((key, ms))
        if len(want) % 3:
            due.append((ms + 500, key))
            answers.append((key, pd.Timestamp(ms + 500, unit="ms")))
    path, told = folder("in"), folder("in")
    fields = "uid string, key string, ts timestamp"
    asks = frame([(u, k, pd.Timestamp(ms, unit="ms")) for ms, u, k in events], fields)
    replies = pd.DataFrame(answers, columns=["key", "ts"])
    far = asks["ts"].max() + pd.Timedelta(days=2)
    for part in (asks[:150], asks[150:], asks[-1:].assign(key="end", ts=far), asks[-1:].assign(key="end", ts=far)):
        feed(spark, part, fields, path)
    for part in (replies[: len(replies) // 2], replies[len(replies) // 2 :], replies[-1:].assign(key="end", ts=far), replies[-1:].assign(key="end", ts=far)):
        feed(spark, part, "key string, ts timestamp", told)
    stream = spec_requests_stream(source(spark, fields, path, "1 hour"), source(spark, "key string, ts timestamp", told, "1 hour"), ["key"])
    got = [tuple(r) for r in collect(stream, "asked", folder("cp")).filter("key <> 'end'").collect()]
    assert sorted(got) == sorted(want) and len(set(k for k, _ in want)) == 4 < len(want)


# ---------------------------------------------------------------------- queue


def queue_fixture(seed, n=500):
    rng = random.Random(seed)
    ms, arrivals, answers = START, [], []
    for i in range(n):
        ms += rng.choice([0, 1, 100, 3000, 50_000])
        client = rng.choice(["a", "b", None])
        arrivals.append((f"u{i:05d}", client, pd.Timestamp(ms, unit="ms")))
        if rng.random() < 0.35:
            answers.append((client, pd.Timestamp(ms + rng.choice([0, 10, 4000]), unit="ms"), None, rng.random() < 0.4))
    return arrivals, answers


def frame(rows, schema):
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


ARRIVALS, ANSWERS = "uid string, client_id string, ts timestamp", "client_id string, ts timestamp, batch_id string, ok boolean"


def by_hand(arrivals, answers, size, seconds, limit):
    """Event by event, with a plain list for the queue."""
    out, queues = Counter(), {}
    rows = [(c or "unknown", t, 1, u, None) for u, c, t in arrivals] + [(c or "unknown", t, 0, "", ok) for c, t, _, ok in answers]
    for client, t, kind, uid, ok in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], bool(r[4]))):
        q = queues.setdefault(client, {"rows": [], "open": [], "at": None, "after": "start"})
        q["open"] = [o for o in q["open"] if t - o[0] <= pd.Timedelta(minutes=10)]
        if kind:
            q["rows"].append(uid)
            q["at"] = q["at"] or t
        elif q["open"]:
            _, sent = q["open"].pop(0)
            q["rows"] += [] if ok else sent
        for lost in q["rows"][: max(0, len(q["rows"]) - limit)]:
            out[client, lost, "lost", None] += 1
        q["rows"] = q["rows"][max(0, len(q["rows"]) - limit) :]
        if kind and (len(q["rows"]) % size == 0 or t - q["at"] >= pd.Timedelta(seconds=seconds)):
            for u in q["rows"]:
                out[client, u, "sent", f"{client}|{q['after']}"] += 1
            q["open"].append((t, q["rows"]))
            q.update(rows=[], at=t, after=uid)
    for client, q in queues.items():
        for u in q["rows"]:
            out[client, u, "waiting", None] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_queue_with_failures_equals_a_replay(spark, seed):
    arrivals, answers = queue_fixture(seed)
    # answers of one instant would be told apart by their outcome only
    answers = list({(c, t): (c, t, b, ok) for c, t, b, ok in answers}.values())
    got = replay_queue(spark.createDataFrame(frame(arrivals, ARRIVALS), ARRIVALS).repartition(3), spark.createDataFrame(frame(answers, ANSWERS), ANSWERS), 4, 30, 9).collect()
    want = by_hand(arrivals, answers, 4, 30, 9)
    assert Counter((r.client_id, r.uid, r.fate, r.batch_id) for r in got) == want
    assert {f for _, _, f, _ in want} == {"sent", "lost", "waiting"} and max(want.values()) == 1
    assert max(Counter(u for _, u, f, _ in want if f == "sent").values()) > 1


def test_queue_on_a_stream(spark, folder):
    arrivals, answers = queue_fixture(3, 300)
    answers = list({(c, t): (c, t, b, ok) for c, t, b, ok in answers}.values())
    table = replay_queue(spark.createDataFrame(frame(arrivals, ARRIVALS), ARRIVALS), spark.createDataFrame(frame(answers, ANSWERS), ANSWERS), 4, 30, 9, left=False)
    at, told = folder("in"), folder("in")
    far = max(t for _, _, t in arrivals) + pd.Timedelta(days=2)
    for part in (arrivals[:100], arrivals[100:], [("end", "nobody", far)], [("end2", "nobody", far)]):
        feed(spark, frame(part, ARRIVALS), ARRIVALS, at)
    for part in (answers[:30], answers[30:], [("nobody", far, None, True)], [("nobody", far, None, True)]):
        feed(spark, frame(part, ANSWERS), ANSWERS, told)
    stream = queue_stream(source(spark, ARRIVALS, at, "1 hour"), source(spark, ANSWERS, told, "1 hour"), 4, 30, 9)
    columns = ["client_id", "uid", "fate", "batch_id", "place", "at_ms"]
    got = Counter(tuple(r) for r in collect(stream, "queue", folder("cp")).filter("client_id <> 'nobody'").select(*columns).collect())
    assert got == Counter(tuple(r) for r in table.select(*columns).collect())


def test_a_named_answer_finds_its_batch():
    queue = Queue("c", 2, 30_000, 100)
    sent = [x for i in range(4) for x in queue.arrive(i, f"u{i}")]
    assert [s[2] for s in sent] == ["c|start"] * 2 + ["c|u1"] * 2
    assert list(queue.answer(9, "c|u1", False)) == [] and queue.rows == ["u2", "u3"]
    assert [b[1] for b in queue.open] == ["c|start"]
    assert list(queue.answer(9, "c|none", False)) == [] and list(queue.answer(700_000, "c|start", False)) == [] and queue.rows == ["u2", "u3"]
