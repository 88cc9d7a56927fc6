"""Queries on streams (D1-D4, E1-E3, F1, G1, G2, G4, G7, A5, P1, P2, P4): a table is fed in parts, the stream's result is read.

Each part is a run of micro-batches that starts from the checkpoint of the one before.  A last row, two
days later and of no client, moves the watermark past all others; it is left out of the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.catalog import query
from plumbline.catalog.contracts import _FETCH_SQL, _dense
from plumbline.catalog.flow import (
    _BATCH_SQL,
    _EVENT_TAIL,
    _INSPECTED_SQL,
    _K_DOCUMENT,
    _QUEUE_SQL,
    _REPORTS_SQL,
    _SECONDS,
    _SHAPED_SQL,
    _SIZE,
    _START,
    _asked,
    _body_sql,
    _queue,
    _replay_sql,
    _reports,
)
from plumbline.catalog.inputs import prop, same_spec, table, wire
from plumbline.functions.planning import shared_folder
from plumbline.operators.envelope import App
from plumbline.operators.queue import replay_queue
from plumbline.session import configure
from plumbline.sources.commit import as_parquet, write_once
from plumbline.sources.specs import load_specs
from plumbline.streaming.gate import LiveSpecs, finish, gate, read_part, stream_kept
from plumbline.streaming.lookup import branch_epochs_stream, seen_by_codegen_stream, spec_asof_stream, spec_requests_stream
from plumbline.streaming.queue import queue_stream
from plumbline.streaming.requests import READY, ready_events, ready_production, ready_schemas, request_stream

_NOBODY = "nobody"
_DELAY = "5 seconds"


class Run:
    """Folders of one run of a stream, in a session whose state has a partition for each core."""

    def __init__(self, spark: SparkSession):
        self.folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
        self.spark = configure(spark.newSession())
        self.spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
        self.spark.conf.set(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def feed(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").parquet(self.path(name))

    def close(self, rows: DataFrame, name: str, **values: Column) -> None:
        """The last row: two days later, of nobody."""
        later = rows.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
        given = {"client_id": F.lit(_NOBODY), "uid": F.lit("end"), **values, "ts": F.col("ts")}
        nothing = lambda f: F.lit(None).cast(f.dataType)
        self.feed(later.select(*[given.get(f.name, nothing(f)).cast(f.dataType).alias(f.name) for f in rows.schema]), name)

    def read(self, name: str, schema, delay: str = _DELAY) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(self.path(name)).withWatermark("ts", delay)

    def sink(self, stream: DataFrame) -> None:
        """Run a stream over what there is; each micro-batch is written once."""
        write = lambda batch, k: write_once(batch, self.path("out"), f"batch-{k:012d}", as_parquet)
        self.schema = stream.schema
        finish(stream.writeStream.foreachBatch(write), self.path("checkpoint"))

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path("out"))


def _halves(rows: DataFrame) -> list[DataFrame]:
    """Rows before and after the middle of their time."""
    low, high = rows.agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts"))).first()
    early = F.unix_millis("ts") < ((low or 0) + (high or 0)) // 2
    return [rows.filter(early), rows.filter(~early)]


def _in_order(spark: SparkSession, inputs: dict[str, DataFrame], stream: Callable[[Run], DataFrame], **last: Column) -> DataFrame:
    """Feed every input half by half, then its last row; run the stream after each."""
    run = Run(spark)
    halves = {name: _halves(rows) for name, rows in inputs.items()}
    for k in range(2):
        for name, of in halves.items():
            run.feed(of[k], name)
        run.sink(stream(run))
    for name, rows in inputs.items():
        run.close(rows, name, **last)
    run.sink(stream(run))
    return run.result(spark)


# ------------------------------------------------------------------ late rows


@query(
    "stream_late_rows",
    f"""WITH fed AS (
      SELECT event_id AS n, {_START} + event_id * 40 AS ms, event_id * 7919 % 4 AS part, event_id % 11 = 0 AS broken, event_id % 13 = 0 AS timeless FROM events),
    reached AS (SELECT p.part, (SELECT max(ms) FROM fed f WHERE f.part < p.part AND NOT broken AND NOT timeless) AS ms FROM (SELECT DISTINCT part FROM fed) p)
    SELECT n, CASE WHEN broken OR timeless THEN 'rejects' WHEN f.ms <= r.ms - 60000 THEN 'late' ELSE 'kept' END AS part
    FROM fed f JOIN reached r USING (part)""",
)
def stream_late_rows(spark, sf):
    """Four parts that overlap in time: what comes too late goes to its own table, and nothing is lost."""
    run = Run(spark)
    n = F.col("event_id")
    rows = table(spark, sf, "events").select(
        n.alias("n"),
        F.when(n % 13 != 0, F.timestamp_millis(F.lit(_START) + n * 40)).alias("ts"),
        F.when(n % 11 == 0, "[1]").otherwise(F.col("props")).alias("props"),
    )
    for part in range(4):
        run.feed(rows.filter(F.col("n") * 7919 % 4 == part), "in")
        stream = run.spark.readStream.schema(rows.schema).parquet(run.path("in"))
        finish(gate(stream, run.path("gate"), "60 seconds"), run.path("checkpoint"))
    found = [read_part(spark, run.path("gate"), p, rows.schema).select("n", F.lit(p).alias("part")) for p in ("kept", "late", "rejects")]
    return found[0].unionByName(found[1]).unionByName(found[2])


# ------------------------------------------------------------------- requests


def _through_gate(spark: SparkSession, rows: DataFrame, ready: Callable[[DataFrame], DataFrame], whole: bool = True, rate: float = 1.0, columns: str = READY) -> DataFrame:
    """Requests of rows that come in two halves: gate, state and sink run after each."""
    run = Run(spark)

    def step() -> None:
        stream = run.spark.readStream.schema(rows.schema).parquet(run.path("in"))
        finish(gate(stream, run.path("gate"), _DELAY, ready), run.path("gate-checkpoint"))
        run.sink(request_stream(stream_kept(run.spark, run.path("gate"), columns, _DELAY), _SIZE, _SECONDS, rate, whole))

    for half in _halves(rows):
        run.feed(half, "in")
        step()
    run.close(rows, "in", event_name=F.lit("end"), source=F.lit("manual"))
    step()
    requests = run.result(spark).filter(~F.startswith("batch_id", F.lit(_NOBODY)) & (F.col("batch_id") != "event|end"))
    return requests.select("batch_id", "n_events", F.md5("request").alias("request"), "gzip")


def _flushed_sql(bodies: str, waiting: str) -> str:
    """Requests of ``bodies``: those sent at once, and the batches of ``waiting`` that a flush closed."""
    return f"""
    waiting AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS wn FROM {waiting}),
    queued AS (
      SELECT client_id, 0::BIGINT AS wn, 0 AS n, ms AS flushed_ms, 'start' AS flushed, NULL::VARCHAR AS uid, NULL::VARCHAR AS after, false AS f FROM waiting WHERE wn = 1
      UNION ALL
      SELECT client_id, wn, CASE WHEN f THEN 0 ELSE n + 1 END, CASE WHEN f THEN ms ELSE flushed_ms END, CASE WHEN f THEN uid ELSE flushed END, uid, flushed, f
      FROM (SELECT r.*, o.n, o.flushed_ms, o.flushed, (o.n + 1) % {_SIZE} = 0 OR r.ms - o.flushed_ms >= {_SECONDS * 1000} AS f
            FROM queued o JOIN waiting r ON r.client_id = o.client_id AND r.wn = o.wn + 1)),
    batched AS (
      SELECT b.*, concat(q.client_id, '|', q.after) AS batch_id, bool_or(q.f) OVER (PARTITION BY q.client_id, q.after) AS closed
      FROM {bodies} b JOIN queued q ON q.uid = b.uid)"""


_REQUESTS_SQL = """SELECT batch_id, CAST(n_events AS INT) AS n_events, md5(request) AS request, length(request) >= 1024 AS gzip FROM r"""
_GROUPED_SQL = "count(*) AS n_events, concat('[', string_agg(body, ',' ORDER BY ms, uid), ']') AS request"


@query(
    "stream_requests",
    f"""WITH RECURSIVE {_INSPECTED_SQL}, {_flushed_sql("bodies", "(SELECT * FROM bodies WHERE NOT spec)")},
    r AS (SELECT batch_id, {_GROUPED_SQL} FROM batched WHERE closed GROUP BY 1
          UNION ALL SELECT concat('event|', uid), 1, concat('[', body, ']') FROM bodies WHERE spec)
    {_REQUESTS_SQL}""",
)
def stream_requests(spark, sf):
    """P1 whole on a stream: doubles dropped, identities named, events validated, requests closed."""
    reports = _reports(spark, sf)
    spec = {"k": prop(minmax={"0,50": ["e", "v1"], "2,": ["v2"]})}
    documents = same_spec(reports, wire(spec, ids=["e", "v1", "v2", "v3", "v4", "v5"])).filter("event_name IN ('click', 'view')")
    specs = load_specs(documents, ["event_name"])
    rows = reports.select("uid", "client_id", "event_name", "ts", "source", "event_id", "event_hash", "props")
    return _through_gate(spark, rows, lambda batch: ready_events(batch, specs, App()))


_SCHEMA_BODY = _body_sql(
    "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))",
    "concat('[{\"propertyName\":\"k\",\"propertyType\":\"', shape, '\"},{\"propertyName\":\"j\",\"propertyType\":\"int\"}]')",
    _EVENT_TAIL,
)


@query(
    "stream_schema_requests",
    f"""WITH RECURSIVE {_SHAPED_SQL}, {_replay_sql('mixed')},
    kept AS (SELECT a.* FROM fold f JOIN asked a ON a.uid = f.uid WHERE NOT dup),
    seen AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS rn FROM kept),
    ids AS (
      SELECT client_id, uid, rn, ms AS last_ms, ms AS created FROM seen WHERE rn = 1
      UNION ALL
      SELECT r.client_id, r.uid, r.rn, r.ms, CASE WHEN r.ms - i.created > 14400000 AND r.ms - i.last_ms > 7200000 THEN r.ms ELSE i.created END
      FROM ids i JOIN seen r ON r.client_id = i.client_id AND r.rn = i.rn + 1),
    documented AS (SELECT s.*, false AS coded, sha256(concat('message|', s.uid)) AS m, sha256(concat(s.client_id, '|', i.created)) AS h FROM seen s JOIN ids i ON i.uid = s.uid),
    bodies AS (SELECT uid, client_id, ms, {_SCHEMA_BODY} AS body FROM documented),
    {_flushed_sql("bodies", "bodies")},
    r AS (SELECT batch_id, {_GROUPED_SQL} FROM batched WHERE closed GROUP BY 1)
    {_REQUESTS_SQL}""",
)
def stream_schema_requests(spark, sf):
    """P2 whole on a stream: ready-made schemas that codegen did not just report, in batches."""
    asked = _asked(spark, sf).withColumns({"source": F.lit("schema"), "props": F.lit(None).cast("string")})
    reports = _reports(spark, sf).select("uid", "client_id", "event_name", "ts", "source", "props")
    mixed = reports.unionByName(asked, allowMissingColumns=True)
    return _through_gate(spark, mixed, lambda batch: ready_schemas(batch, App()))


@query(
    "stream_production",
    f"""WITH RECURSIVE {_BATCH_SQL},
    m AS (SELECT b.*, q.ms, q.n % 2 = 1 AS coded, e.event_type AS event_name, sha256(concat('message|', b.uid)) AS m
          FROM batched b JOIN queue q USING (uid) JOIN events e ON e.event_id = q.n),
    bodies AS (SELECT batch_id, ms, uid, flush, {_body_sql("''", _K_DOCUMENT, _EVENT_TAIL, rate="0.8")} AS body FROM m),
    r AS (SELECT batch_id, {_GROUPED_SQL} FROM bodies GROUP BY 1 HAVING bool_or(flush))
    {_REQUESTS_SQL} WHERE NOT (CAST(concat('0x', substr(md5(batch_id), 1, 8)) AS BIGINT) / 4294967295.0 > 0.8)""",
)
def stream_production(spark, sf):
    """P4 on a stream: extraction, batches and sampling."""
    coded = F.col("n") % 2 == 1
    rows = _queue(spark, sf).withColumns({"event_id": F.when(coded, F.concat(F.lit("evt-"), "event_name")), "event_hash": F.lit("h1")})
    rows = rows.select("uid", "client_id", "event_name", "ts", "event_id", "event_hash", "props")
    return _through_gate(spark, rows, lambda batch: ready_production(batch, App(), 0.8), whole=False, rate=0.8)


@query(
    "stream_changing_specs",
    """WITH half AS (SELECT (min(event_id) * 2000 + min(event_id) // 2000 * 40000 + max(event_id) * 2000 + max(event_id) // 2000 * 40000) // 2 AS ms FROM events)
    SELECT event_id AS n, CASE WHEN event_type = 'click' OR event_type = 'view' AND event_id * 2000 + event_id // 2000 * 40000 >= half.ms
                               THEN 'immediate' ELSE 'batch' END AS route FROM events, half""",
)
def stream_changing_specs(spark, sf):
    """A specification that is added between two micro-batches holds from the second one on."""
    run = Run(spark)
    rows = _queue(spark, sf).select("uid", "n", "client_id", "event_name", "ts", "props")
    rows = rows.withColumns({"source": F.lit("manual"), "event_id": F.lit(None).cast("string"), "event_hash": F.lit(None).cast("string")})
    document = wire({"k": prop(minmax={"0,50": ["e"]})}, ids=["e"])
    live = LiveSpecs(lambda: run.spark.read.schema("event_name string, spec_json string").parquet(run.path("specs")), ["event_name"])
    for half, name in zip(_halves(rows), ("click", "view"), strict=True):
        run.feed(run.spark.createDataFrame([(name, document)], "event_name string, spec_json string"), "specs")
        run.feed(half, "in")
        stream = run.spark.readStream.schema(rows.schema).parquet(run.path("in"))
        finish(gate(stream, run.path("gate"), _DELAY, lambda batch: ready_events(batch, live.current(), App())), run.path("checkpoint"))
    kept = read_part(spark, run.path("gate"), "kept", READY)
    return kept.select(F.col("uid").cast("long").alias("n"), "route")


# -------------------------------------------------------------------- lookups


@query(
    "stream_seen_by_codegen",
    f"""WITH {_REPORTS_SQL}
    SELECT uid, EXISTS (SELECT 1 FROM tagged c WHERE c.source = 'codegen' AND c.client_id = t.client_id AND c.params = t.params
                        AND t.ms - c.ms BETWEEN 0 AND 300) AS seen_by_codegen
    FROM tagged t WHERE source = 'manual'""",
)
def stream_seen_by_codegen(spark, sf):
    rows = _reports(spark, sf).select("uid", "client_id", "source", "props", "ts")
    inputs = {"checks": rows.filter("source = 'manual'"), "events": rows.filter("source = 'codegen'")}
    found = _in_order(
        spark, inputs, lambda run: seen_by_codegen_stream(run.read("checks", rows.schema), run.read("events", rows.schema)), source=F.lit("codegen")
    )
    return found.filter("uid <> 'end'").select("uid", "seen_by_codegen")


def _fetches(spark, sf):
    events, fetches = _dense(spark, sf)
    told = fetches.select("client_id", "event_name", "fetch_id", F.col("fetched_at").alias("ts"), "branch_id", F.col("branch_id").alias("spec"))
    return events.select(F.col("n").cast("string").alias("uid"), "client_id", "event_name", "ts"), told


@query("stream_branch_epochs", f"WITH {_FETCH_SQL} SELECT n AS fetch_id, changed AS branch_changed, epoch_ms FROM epochs")
def stream_branch_epochs(spark, sf):
    _, told = _fetches(spark, sf)
    found = _in_order(spark, {"fetches": told}, lambda run: branch_epochs_stream(run.read("fetches", told.schema), ["client_id"]), fetch_id=F.lit(-1))
    return found.filter("fetch_id >= 0").select("fetch_id", "branch_changed", "epoch_ms")


@query(
    "stream_spec_asof",
    f"""WITH {_FETCH_SQL},
    j AS (SELECT d.n, d.ms, e.ms AS fms, e.branch, e.invalid_ms
          FROM dense d ASOF LEFT JOIN epochs e ON d.client_id = e.client_id AND d.event_name = e.event_name AND d.ms >= e.ms)
    SELECT n, CASE WHEN fms IS NULL OR ms - fms > 60000 OR coalesce(ms >= invalid_ms, false) THEN 'miss'
                   WHEN branch IS NULL THEN 'absent' ELSE 'hit' END AS state,
           CASE WHEN NOT (fms IS NULL OR ms - fms > 60000 OR coalesce(ms >= invalid_ms, false)) THEN branch END AS spec FROM j""",
)
def stream_spec_asof(spark, sf):
    """Fetches and events of a client in one state; a new branch takes all its specifications out of force."""
    events, told = _fetches(spark, sf)
    # the inputs are cut at other times: the delay covers that
    stream = lambda run: spec_asof_stream(run.read("events", events.schema, "10 minutes"), run.read("fetches", told.schema, "10 minutes"), ["client_id"], ["event_name"])
    found = _in_order(spark, {"events": events, "fetches": told}, stream, fetch_id=F.lit(-1))
    return found.filter("uid <> 'end'").select(F.col("uid").cast("long").alias("n"), F.col("spec_state").alias("state"), "spec")


# an event a second; a request is answered half a second later unless its number says otherwise
_ASKING_SQL = f"""
asking AS (SELECT event_id AS n, event_type AS key, {_START} + event_id * 1000 AS ms FROM events),
told AS (SELECT event_id AS n, event_type AS key, {_START} + event_id * 1000 + 500 AS ms FROM events WHERE event_id % 7 < 2),
both_sides AS (SELECT *, 1 AS kind FROM asking UNION ALL SELECT *, 0 FROM told),
ordered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ms, kind, n) AS rn FROM both_sides),
fold AS (
  SELECT DISTINCT key, 0::BIGINT AS rn, NULL::BIGINT AS asked, NULL::BIGINT AS loaded, NULL::BIGINT AS ms, false AS send FROM ordered
  UNION ALL
  SELECT key, rn, CASE WHEN kind = 0 THEN NULL WHEN s THEN ms ELSE asked END, CASE WHEN kind = 0 THEN ms ELSE loaded END, ms, s
  FROM (SELECT o.*, f.asked, f.loaded,
               o.kind = 1 AND NOT coalesce(o.ms - f.loaded <= 60000, false) AND NOT coalesce(o.ms - f.asked <= 2000, false) AS s
        FROM fold f JOIN ordered o ON o.key = f.key AND o.rn = f.rn + 1))
"""


@query("stream_spec_requests", f"WITH RECURSIVE {_ASKING_SQL} SELECT key, ms AS asked_ms FROM fold WHERE send")
def stream_spec_requests(spark, sf):
    """A key is asked for once while its request is open, and again when its answer has aged."""
    rows = table(spark, sf, "events").select(F.col("event_id").alias("n"), F.col("event_type").alias("key"))
    asking = rows.select(F.col("n").cast("string").alias("uid"), "key", F.timestamp_millis(F.lit(_START) + F.col("n") * 1000).alias("ts"))
    told = rows.filter("n % 7 < 2").select("key", F.timestamp_millis(F.lit(_START) + F.col("n") * 1000 + 500).alias("ts"))
    stream = lambda run: spec_requests_stream(run.read("events", asking.schema, "1 minute"), run.read("answers", told.schema, "1 minute"), ["key"])
    found = _in_order(spark, {"events": asking, "answers": told}, stream, key=F.lit(_NOBODY))
    return found.filter(F.col("key") != _NOBODY)


# ---------------------------------------------------------------------- queue

_LIMIT = 12


def _queue_fold(left: bool) -> str:
    """Event-by-event replay of queues with answers; an answer is for the oldest open batch."""
    waiting = f"""UNION ALL
    SELECT client_id, unnest(queue) AS uid, 'waiting' AS fate, NULL AS batch_id, unnest(range(len(queue))) AS place, ms AS at_ms FROM last""" if left else ""
    return f"""{_QUEUE_SQL},
    told AS (SELECT client_id, ms + 700 AS ms, n % 3 = 0 AS ok FROM queue WHERE n % 5 < 2),
    mixed AS (SELECT client_id, ms, 1 AS kind, uid, NULL::BOOLEAN AS ok FROM queue UNION ALL SELECT client_id, ms, 0, '', ok FROM told),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, kind, uid) AS rn FROM mixed),
    fold AS (
      SELECT DISTINCT client_id, 0::BIGINT AS rn, []::VARCHAR[] AS queue, []::STRUCT(ms BIGINT, uids VARCHAR[])[] AS open, NULL::BIGINT AS flushed_ms, 'start' AS flushed,
             []::VARCHAR[] AS lost, []::VARCHAR[] AS sent, NULL::VARCHAR AS batch_id, NULL::BIGINT AS ms FROM ordered
      UNION ALL
      SELECT client_id, rn, CASE WHEN f THEN []::VARCHAR[] ELSE kept END,
        CASE WHEN f THEN list_append(still, {{'ms': ms, 'uids': kept}}::STRUCT(ms BIGINT, uids VARCHAR[])) ELSE still END,
        CASE WHEN f THEN ms ELSE begun END, CASE WHEN f THEN uid ELSE flushed END, dropped, CASE WHEN f THEN kept ELSE []::VARCHAR[] END,
        CASE WHEN f THEN concat(client_id, '|', flushed) END, ms
      FROM (
        SELECT *, kind = 1 AND (len(kept) % {_SIZE} = 0 OR ms - begun >= {_SECONDS * 1000}) AS f
        FROM (
          SELECT *, grown[greatest(len(grown) - {_LIMIT}, 0) + 1:] AS kept, grown[:greatest(len(grown) - {_LIMIT}, 0)] AS dropped
          FROM (
            SELECT r.*, p.flushed, CASE WHEN r.kind = 1 THEN coalesce(p.flushed_ms, r.ms) ELSE p.flushed_ms END AS begun,
              CASE WHEN r.kind = 0 AND len(p.live) > 0 THEN p.live[2:] ELSE p.live END AS still,
              CASE WHEN r.kind = 1 THEN list_append(p.queue, r.uid) WHEN len(p.live) > 0 AND NOT r.ok THEN list_concat(p.queue, p.live[1].uids) ELSE p.queue END AS grown
            FROM (SELECT f.*, o.rn AS next, list_filter(f.open, lambda b: o.ms - b.ms <= 600000) AS live FROM fold f JOIN ordered o ON o.client_id = f.client_id AND o.rn = f.rn + 1) p
            JOIN ordered r ON r.client_id = p.client_id AND r.rn = p.next)))),
    last AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY rn DESC) = 1)
    SELECT client_id, uid, fate, batch_id, CAST(place AS INT) AS place, at_ms FROM (
    SELECT client_id, unnest(sent) AS uid, 'sent' AS fate, batch_id, unnest(range(len(sent))) AS place, ms AS at_ms FROM fold
    UNION ALL SELECT client_id, unnest(lost), 'lost', NULL, NULL, ms FROM fold {waiting})"""


def _arrivals_and_answers(spark, sf):
    rows = _queue(spark, sf)
    later = F.timestamp_millis(F.unix_millis("ts") + 700)
    answers = rows.filter("n % 5 < 2").select("client_id", later.alias("ts"), F.lit(None).cast("string").alias("batch_id"), (F.col("n") % 3 == 0).alias("ok"))
    return rows.select("uid", "client_id", "ts"), answers


@query("replay_queue", f"WITH RECURSIVE {_queue_fold(left=True)}")
def replay_queue_query(spark, sf):
    """Failed batches come back, change when the next one is full, and the newest places of the queue stay."""
    arrivals, answers = _arrivals_and_answers(spark, sf)
    return replay_queue(arrivals, answers, _SIZE, _SECONDS, _LIMIT)


@query("stream_queue", f"WITH RECURSIVE {_queue_fold(left=False)}")
def stream_queue(spark, sf):
    arrivals, answers = _arrivals_and_answers(spark, sf)
    stream = lambda run: queue_stream(run.read("arrivals", arrivals.schema, "1 minute"), run.read("answers", answers.schema, "1 minute"), _SIZE, _SECONDS, _LIMIT)
    found = _in_order(spark, {"arrivals": arrivals, "answers": answers}, stream, ok=F.lit(True))
    return found.filter(F.col("client_id") != _NOBODY)
