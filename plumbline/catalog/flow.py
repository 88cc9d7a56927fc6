"""Queries on deduplication, identity, batching and envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import query
from plumbline.catalog.inputs import prop, same_spec, table, wire
from plumbline.operators.batching import (
    adopt_sampling_rate,
    assign_batches,
    count_batches,
    drop_null_events,
    requeue_failed,
    retain_latest,
    route,
    sample_batches,
)
from plumbline.operators.dedup import dedup_events, find_duplicates, params_fingerprint, schema_fingerprint, seen_by_codegen
from plumbline.operators.envelope import App, encode_batches, event_body, session_body
from plumbline.operators.extract import extract_document
from plumbline.operators.identity import assign_stream_id, backfill_unknown_stream, session_started_rows
from plumbline.operators.lookup import lookup_spec
from plumbline.plans.inspect import extract_only, inspect_events, inspect_schemas, outgoing_requests, production_profile
from plumbline.sources.specs import load_specs

_START = 1704067200000

# ------------------------------------------------------- dense double reports

# a row every 40 ms; every third is reported again by the other path up to 600 ms later,
# every fifth of those with other properties; each comes with a ready-made schema as well
_REPORTS_SQL = f"""
base AS (
  SELECT event_id AS n, concat('c', user_id % 4) AS client_id, event_type AS event_name, {_START} + event_id * 40 AS ms,
         CASE WHEN event_id % 2 = 0 THEN 'manual' ELSE 'codegen' END AS source,
         CAST(props ->> '$.k' AS INT) % 5 AS k, event_id % 4 = 1 AS str FROM events),
reports AS (
  SELECT concat(lpad(CAST(n AS varchar), 10, '0'), 'a') AS uid, n, client_id, event_name, ms, source, k, str FROM base
  UNION ALL
  SELECT concat(lpad(CAST(n AS varchar), 10, '0'), 'b'), n, client_id, event_name, ms + (n * 37) % 600,
         CASE WHEN source = 'manual' THEN 'codegen' ELSE 'manual' END, CASE WHEN n % 5 = 0 THEN k + 1 ELSE k END, str
  FROM base WHERE n % 3 = 0),
tagged AS (SELECT *, concat(k, CASE WHEN str THEN 's' ELSE 'i' END) AS params, CASE WHEN str THEN 'string' ELSE 'int' END AS shape FROM reports)
"""

_SCHEMAS_SQL = """
asked AS (
  SELECT concat(lpad(CAST(n AS varchar), 10, '0'), 's') AS uid, n, client_id, event_name, ms + 100 AS ms, 'schema' AS source,
         NULL AS params, CASE WHEN n % 2 = 0 THEN 'int' ELSE 'string' END AS shape
  FROM base)
"""


def _replay_sql(rows: str) -> str:
    """Event-by-event replay of the two deduplication rules over ``rows``."""
    kind = "STRUCT(ms BIGINT, uid VARCHAR, source VARCHAR, params VARCHAR, shape VARCHAR)"
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY client_id, event_name ORDER BY ms, uid) AS rn FROM {rows}),
fold AS (
  SELECT DISTINCT client_id, event_name, 0::BIGINT AS rn, []::{kind}[] AS pending, NULL::VARCHAR AS uid, false AS dup FROM numbered
  UNION ALL
  SELECT client_id, event_name, rn,
    CASE WHEN source = 'schema' THEN CASE WHEN len(same) > 0 THEN list_filter(live, lambda p: p.uid <> same[1].uid) ELSE live END
         WHEN len(doubles) > 0 THEN []::{kind}[]
         ELSE list_append(live, {{'ms': ms, 'uid': uid, 'source': source, 'params': params, 'shape': shape}}::{kind}) END,
    uid, CASE WHEN source = 'schema' THEN len(same) > 0 ELSE len(doubles) > 0 END
  FROM (
    SELECT *, list_filter(live, lambda p: p.source = 'codegen' AND p.shape = shape) AS same,
      list_filter(live, lambda p: p.source = CASE WHEN source = 'manual' THEN 'codegen' ELSE 'manual' END AND p.params = params) AS doubles
    FROM (SELECT r.*, list_filter(f.pending, lambda p: r.ms - p.ms <= 300) AS live
          FROM fold f JOIN numbered r ON r.client_id = f.client_id AND r.event_name = f.event_name AND r.rn = f.rn + 1)))
"""


def _reports(spark, sf):
    base = table(spark, sf, "events").select(
        F.col("event_id").alias("n"),
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("client_id"),
        F.col("event_type").alias("event_name"),
        (F.lit(_START) + F.col("event_id") * 40).alias("ms"),
        F.when(F.col("event_id") % 2 == 0, "manual").otherwise("codegen").alias("source"),
        (F.get_json_object("props", "$.k").cast("int") % 5).alias("k"),
    )
    value = lambda k: F.when(F.col("n") % 4 == 1, F.concat(F.lit('"'), k.cast("string"), F.lit('"'))).otherwise(k.cast("string"))
    uid = lambda mark: F.concat(F.lpad(F.col("n").cast("string"), 10, "0"), F.lit(mark))
    first = base.select(
        uid("a").alias("uid"), "n", "client_id", "event_name", "ms", "source",
        F.concat(F.lit('{"k":'), value(F.col("k")), F.lit(',"j":1}')).alias("props"),
    )
    changed = F.when(F.col("n") % 5 == 0, F.col("k") + 1).otherwise(F.col("k"))
    again = base.filter("n % 3 = 0").select(
        uid("b").alias("uid"), "n", "client_id", "event_name",
        (F.col("ms") + (F.col("n") * 37) % 600).alias("ms"),
        F.when(F.col("source") == "manual", "codegen").otherwise("manual").alias("source"),
        F.concat(F.lit('{ "j": 1.0, "k": '), value(changed), F.lit(" }")).alias("props"),
    )
    coded = F.col("source") == "codegen"
    return first.unionByName(again).withColumns(
        {
            "ts": F.timestamp_millis("ms"),
            "event_id": F.when(coded, F.concat(F.lit("evt-"), "event_name")),
            "event_hash": F.when(coded, F.lit("h1")),
        }
    )


def _asked(spark, sf):
    rows = _reports(spark, sf).filter("uid LIKE '%a'")
    kind = F.when(F.col("n") % 2 == 0, "int").otherwise("string")
    document = F.concat(
        F.lit('[{"propertyName":"k","propertyType":"'), kind, F.lit('"},{"propertyName":"j","propertyType":"int"}]')
    )
    return rows.select(
        F.concat(F.lpad(F.col("n").cast("string"), 10, "0"), F.lit("s")).alias("uid"),
        "client_id", "event_name", F.timestamp_millis(F.col("ms") + 100).alias("ts"), document.alias("schema_json"),
    )


@query(
    "dedup_cross_source",
    f"WITH RECURSIVE {_REPORTS_SQL}, {_replay_sql('tagged')} SELECT uid FROM fold WHERE rn > 0 AND NOT dup",
)
def dedup_cross_source(spark, sf):
    return dedup_events(_reports(spark, sf)).select("uid")


# schemas compare documents in order, so only first reports (k before j) have their shape
_SHAPED_SQL = f"""{_REPORTS_SQL}, {_SCHEMAS_SQL},
mixed AS (SELECT uid, client_id, event_name, ms, source, params, CASE WHEN uid LIKE '%a' THEN shape END AS shape FROM tagged
          UNION ALL SELECT uid, client_id, event_name, ms, source, params, shape FROM asked)"""


@query(
    "dedup_schema_shape",
    f"WITH RECURSIVE {_SHAPED_SQL}, {_replay_sql('mixed')} SELECT uid FROM fold WHERE dup",
)
def dedup_schema_shape(spark, sf):
    """All duplicates when events and ready-made schemas come mixed."""
    events = extract_document(_reports(spark, sf), out="schema_json")
    schemas = _asked(spark, sf).withColumns({"source": F.lit("schema"), "props": F.lit(None).cast("string")})
    mixed = events.unionByName(schemas, allowMissingColumns=True)
    return find_duplicates(mixed.withColumn("shape", schema_fingerprint(F.col("schema_json"))), schema="shape")


@query(
    "seen_by_codegen",
    f"""WITH {_REPORTS_SQL}
    SELECT uid, EXISTS (SELECT 1 FROM tagged c WHERE c.source = 'codegen' AND c.client_id = t.client_id AND c.params = t.params
                        AND t.ms - c.ms BETWEEN 0 AND 300) AS seen_by_codegen
    FROM tagged t WHERE source = 'manual'""",
)
def seen_by_codegen_query(spark, sf):
    reports = _reports(spark, sf)
    return seen_by_codegen(reports.filter("source = 'manual'"), reports).select("uid", "seen_by_codegen")


@query(
    "params_fingerprint",
    f"WITH {_REPORTS_SQL} SELECT min(uid) AS first_uid, count(*) AS n FROM tagged GROUP BY params",
)
def params_fingerprint_query(spark, sf):
    groups = _reports(spark, sf).groupBy(params_fingerprint(F.col("props")).alias("params"))
    return groups.agg(F.min("uid").alias("first_uid"), F.count("*").alias("n")).drop("params")


# ----------------------------------------------------------------- identities

# the event month squeezed by eight: some clients come back within two hours, some do not
_VISITS_SQL = f"""
visits AS (
  SELECT lpad(CAST(event_id AS varchar), 12, '0') AS uid, concat('u', user_id) AS client_id,
         {_START} + (epoch_us(ts) // 1000 - {_START}) // 8 AS ms, event_type AS event_name, props ->> '$.k' AS k FROM events),
ordered AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS rn FROM visits),
ids AS (
  SELECT client_id, uid, rn, ms AS last_ms, ms AS created FROM ordered WHERE rn = 1
  UNION ALL
  SELECT r.client_id, r.uid, r.rn, r.ms,
         CASE WHEN r.ms - i.created > 14400000 AND r.ms - i.last_ms > 7200000 THEN r.ms ELSE i.created END
  FROM ids i JOIN ordered r ON r.client_id = i.client_id AND r.rn = i.rn + 1),
hashed AS (SELECT *, sha256(concat(client_id, '|', created)) AS h FROM ids),
streams AS (SELECT uid, client_id, last_ms AS ms,
  concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12)) AS stream_id FROM hashed)
"""


def _visits(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("uid"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("client_id"),
        F.timestamp_millis(F.lit(_START) + F.floor((ms - _START) / 8)).alias("ts"),
        F.col("event_type").alias("event_name"),
        "props",
        F.get_json_object("props", "$.k").alias("k"),
        F.col("event_id").alias("n"),
    )


@query("assign_stream_id", f"WITH RECURSIVE {_VISITS_SQL} SELECT uid, stream_id FROM streams")
def assign_stream_id_query(spark, sf):
    return assign_stream_id(_visits(spark, sf)).select("uid", "stream_id")


@query(
    "session_started_rows",
    f"""WITH RECURSIVE {_VISITS_SQL} SELECT stream_id, arg_min(uid, (ms, uid)) AS uid, 'sessionStarted' AS type FROM streams GROUP BY stream_id""",
)
def session_started_query(spark, sf):
    return session_started_rows(assign_stream_id(_visits(spark, sf))).select("stream_id", "uid", "type")


@query(
    "backfill_unknown_stream",
    """WITH q AS (SELECT event_id AS n, event_id // 10 AS batch_id,
        CASE WHEN event_id // 10 % 5 = 0 OR CAST(props ->> '$.k' AS INT) % 3 = 0 THEN 'unknown' ELSE concat('s', user_id) END AS s FROM events)
    SELECT n, CASE WHEN s <> 'unknown' THEN s ELSE coalesce(
        last_value(CASE WHEN s <> 'unknown' THEN s END IGNORE NULLS) OVER (PARTITION BY batch_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
        concat('cur-', batch_id)) END AS stream_id FROM q""",
)
def backfill_query(spark, sf):
    batch = F.floor(F.col("event_id") / 10)
    unknown = (batch % 5 == 0) | (F.get_json_object("props", "$.k").cast("int") % 3 == 0)
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("n"),
        batch.alias("batch_id"),
        F.when(unknown, "unknown").otherwise(F.concat(F.lit("s"), F.col("user_id").cast("string"))).alias("stream_id"),
        F.concat(F.lit("cur-"), batch.cast("string")).alias("current_stream_id"),
    )
    return backfill_unknown_stream(rows, order=["n"]).select("n", "stream_id")


# -------------------------------------------------------------------- batches

_SIZE, _SECONDS = 5, 30
# a row every two seconds, a pause of forty after each two thousand; one busy client, one usual, one rare
_QUEUE_SQL = f"""
queue AS (
  SELECT lpad(CAST(event_id AS varchar), 12, '0') AS uid, event_id AS n,
         CASE WHEN user_id % 7 < 3 THEN 'busy' WHEN user_id % 7 < 6 THEN 'usual' ELSE 'rare' END AS client_id,
         {_START} + event_id * 2000 + (event_id // 2000) * 40000 AS ms FROM events)
"""
_BATCH_SQL = f"""{_QUEUE_SQL},
ordered AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS rn FROM queue),
fold AS (
  SELECT client_id, 0::BIGINT AS rn, 0 AS waiting, ms AS flushed_ms, 'start' AS flushed, NULL::VARCHAR AS uid, NULL::VARCHAR AS after, false AS flush
  FROM ordered WHERE rn = 1
  UNION ALL
  SELECT client_id, rn, CASE WHEN f THEN 0 ELSE waiting + 1 END, CASE WHEN f THEN ms ELSE flushed_ms END,
         CASE WHEN f THEN uid ELSE flushed END, uid, flushed, f
  FROM (SELECT r.*, o.waiting, o.flushed_ms, o.flushed,
               (o.waiting + 1) % {_SIZE} = 0 OR r.ms - o.flushed_ms >= {_SECONDS * 1000} AS f
        FROM fold o JOIN ordered r ON r.client_id = o.client_id AND r.rn = o.rn + 1)),
batched AS (SELECT uid, client_id, concat(client_id, '|', after) AS batch_id, flush FROM fold WHERE rn > 0)
"""


def _queue(spark, sf):
    lane = F.col("user_id") % 7
    return table(spark, sf, "events").select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("uid"),
        F.col("event_id").alias("n"),
        F.when(lane < 3, "busy").when(lane < 6, "usual").otherwise("rare").alias("client_id"),
        F.timestamp_millis(F.lit(_START) + F.col("event_id") * 2000 + F.floor(F.col("event_id") / 2000) * 40000).alias("ts"),
        "props",
        F.col("event_type").alias("event_name"),
    )


@query("assign_batches", f"WITH RECURSIVE {_BATCH_SQL} SELECT uid, batch_id, flush FROM batched")
def assign_batches_query(spark, sf):
    return assign_batches(_queue(spark, sf), _SIZE, _SECONDS).select("uid", "batch_id", "flush")


@query(
    "count_batches",
    f"WITH {_QUEUE_SQL} SELECT uid, (row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) - 1) // {_SIZE} AS batch_no FROM queue",
)
def count_batches_query(spark, sf):
    return count_batches(_queue(spark, sf), _SIZE).select("uid", "batch_no")


@query(
    "retain_latest",
    f"""WITH {_QUEUE_SQL} SELECT uid FROM queue
    QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY ms DESC, uid DESC) <= 100""",
)
def retain_latest_query(spark, sf):
    return retain_latest(_queue(spark, sf), 100).select("uid")


_NULLS = "n % 9 = 0 OR floor(n / 3) % 4 = 0"


@query(
    "drop_null_events",
    f"""WITH {_QUEUE_SQL} SELECT CAST(floor(n / 3) AS BIGINT) AS batch_id, CAST(count(*) AS INT) AS n_events FROM queue WHERE NOT ({_NULLS}) GROUP BY 1""",
)
def drop_null_query(spark, sf):
    """Batches that lose all their rows vanish."""
    rows = _queue(spark, sf).withColumns(
        {"batch_id": F.floor(F.col("n") / 3), "body": F.expr(f"CASE WHEN NOT ({_NULLS}) THEN props END")}
    )
    return encode_batches(drop_null_events(rows)).select("batch_id", "n_events")


@query(
    "sample_batches",
    f"""WITH {_QUEUE_SQL}, b AS (SELECT uid, concat(client_id, '-', n // 10) AS batch_id FROM queue)
    SELECT uid, batch_id FROM b WHERE NOT (CAST(concat('0x', substr(md5(batch_id), 1, 8)) AS BIGINT) / 4294967295.0 > 0.6)""",
)
def sample_batches_query(spark, sf):
    batch = F.concat_ws("-", "client_id", F.floor(F.col("n") / 10).cast("string"))
    return sample_batches(_queue(spark, sf).withColumn("batch_id", batch), F.lit(0.6)).select("uid", "batch_id")


@query(
    "adopt_sampling_rate",
    f"""WITH {_QUEUE_SQL}, src AS (SELECT q.*, CAST(e.props ->> '$.k' AS INT) AS k FROM queue q JOIN events e ON e.event_id = q.n),
    told AS (SELECT client_id, ms, (k % 10) / 10.0 AS rate FROM src WHERE n % 3 <> 0)
    SELECT s.uid AS batch_id, coalesce(t.rate, 1.0)::DOUBLE AS rate
    FROM src s ASOF LEFT JOIN told t ON s.client_id = t.client_id AND s.ms >= t.ms""",
)
def adopt_rate_query(spark, sf):
    """Rates a client was told; a third of the answers hold no valid number."""
    rows = _queue(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    valid = (F.col("k") % 10) / F.lit(10.0)
    rate = F.when(F.col("n") % 6 == 0, float("nan")).when(F.col("n") % 3 == 0, None).otherwise(valid)
    told = rows.select("client_id", "ts", rate.alias("rate"))
    batches = rows.select(F.col("uid").alias("batch_id"), "client_id", F.col("ts").alias("sent_at"))
    return adopt_sampling_rate(batches, told).select("batch_id", "rate")


def _small_spec(rows):
    spec = {"k": prop(minmax={"0,50": ["e", "v1"], "10,": ["v2"]})}
    return load_specs(same_spec(rows, wire(spec, ids=["e", "v1", "v2"])).filter("event_name IN ('click', 'view')"), ["event_name"])


@query(
    "route",
    """SELECT event_id AS n, CASE WHEN event_type IN ('click', 'view') THEN 'immediate' ELSE 'batch' END AS route, 'batch' AS prod_route FROM events""",
)
def route_query(spark, sf):
    rows = _queue(spark, sf)
    routed = route(lookup_spec(rows, _small_spec(rows)))
    return route(routed.withColumnRenamed("route", "dev_route"), "prod").select(
        "n", F.col("dev_route").alias("route"), F.col("route").alias("prod_route")
    )


@query(
    "requeue_failed",
    f"""WITH {_QUEUE_SQL}, sent AS (SELECT uid, n, n // 10 AS b FROM queue WHERE n % 2 = 0)
    SELECT uid, 0 AS queue_part, NULL::VARCHAR AS metadata FROM queue WHERE n % 2 = 1
    UNION ALL SELECT uid, 1, NULL FROM sent WHERE b % 3 <> 0""",
)
def requeue_query(spark, sf):
    rows = _queue(spark, sf).withColumns({"batch_id": F.floor(F.col("n") / 10), "metadata": F.lit("m")})
    sent = rows.filter("n % 2 = 0").select("uid", "batch_id", "metadata")
    acks = sent.filter("batch_id % 3 = 0").select("batch_id")
    arrivals = rows.filter("n % 2 = 1").select("uid", F.lit(None).cast("string").alias("metadata"))
    return requeue_failed(sent, acks, arrivals).select("uid", "queue_part", "metadata")


# ------------------------------------------------------------------ envelopes


def _body_sql(stream: str, document: str, tail: str, ms: str = "ms", rate: str = "1") -> str:
    return f"""concat('{{"apiKey":"api-key","appName":"app","appVersion":"1.0.0","libVersion":"1.0.0","env":"dev","libPlatform":"web","messageId":"',
      substr(m, 1, 8), '-', substr(m, 9, 4), '-4', substr(m, 14, 3), '-a', substr(m, 18, 3), '-', substr(m, 21, 12),
      '","trackingId":"","createdAt":"', strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S.%g'), 'Z","sessionId":"","streamId":"', {stream},
      '","samplingRate":{rate},', {tail.format(document=document)})"""


_EVENT_TAIL = (
    "'\"type\":\"event\",\"eventName\":\"', event_name, '\",\"eventProperties\":', {document}, "
    "',\"codegenFunction\":', CASE WHEN coded THEN concat('true,\"eventId\":\"evt-', event_name, '\",\"eventHash\":\"h1\"') "
    "ELSE 'false,\"eventId\":null,\"eventHash\":null' END, '}}'"
)
_K_DOCUMENT = "'[{\"propertyName\":\"k\",\"propertyType\":\"int\"}]'"


@query(
    "base_envelope",
    f"""WITH RECURSIVE {_VISITS_SQL}, m AS (SELECT *, sha256(concat('message|', uid)) AS m FROM streams)
    SELECT uid, {_body_sql('stream_id', '', "'\"type\":\"sessionStarted\"}}'")} AS body FROM m""",
)
def base_envelope(spark, sf):
    rows = assign_stream_id(_visits(spark, sf))
    return rows.select("uid", session_body(App()).alias("body"))


@query(
    "event_envelope",
    f"""WITH {_QUEUE_SQL}, m AS (SELECT q.uid, q.ms, e.event_type AS event_name, q.n % 2 = 1 AS coded, sha256(concat('message|', uid)) AS m
                                 FROM queue q JOIN events e ON e.event_id = q.n)
    SELECT uid, replace({_body_sql("'s'", _K_DOCUMENT, _EVENT_TAIL)}, CASE WHEN event_name = 'click' THEN '"h1"}}' ELSE '~' END,
        CASE WHEN event_name = 'click' THEN '"h1","eventSpecMetadata":{{"schemaId":"x","branchId":"main","latestActionId":"a"}},"validatedBranchId":"main"}}' ELSE '~' END) AS body FROM m""",
)
def event_envelope(spark, sf):
    coded = F.col("n") % 2 == 1
    metadata = F.when(
        coded & (F.col("event_name") == "click"),
        F.struct(
            F.lit("x").alias("schemaId"), F.lit("main").alias("branchId"), F.lit("a").alias("latestActionId"),
            F.lit(None).cast("string").alias("sourceId"),
        ),
    )
    rows = extract_document(_queue(spark, sf)).withColumns(
        {
            "event_id": F.when(coded, F.concat(F.lit("evt-"), "event_name")),
            "event_hash": F.lit("h1"),
            "stream_id": F.lit("s"),
            "metadata": metadata,
        }
    )
    return rows.select("uid", event_body(App()).alias("body"))


@query(
    "write_bodies",
    f"""WITH {_QUEUE_SQL}, b AS (SELECT q.n // 40 * 3 + CASE WHEN q.n % 40 < 2 THEN 0 WHEN q.n % 40 < 12 THEN 1 ELSE 2 END AS batch_id, q.ms, q.uid, concat('{{"n":', q.n, ',"p":', e.props, '}}') AS body
                                 FROM queue q JOIN events e ON e.event_id = q.n),
    r AS (SELECT batch_id, count(*) AS n_events, concat('[', string_agg(body, ',' ORDER BY ms, uid), ']') AS request FROM b GROUP BY 1)
    SELECT batch_id, CAST(n_events AS INT) AS n_events, md5(request) AS request, length(request) >= 300 AS long_request,
           length(request) >= 1024 AS gzip FROM r""",
)
def write_bodies_query(spark, sf):
    """Requests as they would be written, with their compression flag."""
    part = F.when(F.col("n") % 40 < 2, 0).when(F.col("n") % 40 < 12, 1).otherwise(2)
    rows = _queue(spark, sf).select(
        (F.floor(F.col("n") / 40) * 3 + part).alias("batch_id"),
        "ts",
        "uid",
        F.concat(F.lit('{"n":'), F.col("n").cast("string"), F.lit(',"p":'), F.col("props"), F.lit("}")).alias("body"),
    )
    encoded = encode_batches(rows)
    return encoded.select(
        "batch_id", "n_events", F.md5("request").alias("request"), (F.length("request") >= 300).alias("long_request"), "gzip"
    )


# ---------------------------------------------------------- whole inspections




@query(
    "inspect_events",
    f"""WITH RECURSIVE {_REPORTS_SQL}, {_replay_sql('tagged')},
    kept AS (SELECT t.* FROM fold f JOIN tagged t ON t.uid = f.uid WHERE f.rn > 0 AND NOT dup),
    ided AS (SELECT *, event_name IN ('click', 'view') AS spec,
             CASE WHEN event_name NOT IN ('click', 'view') THEN '' WHEN str THEN ',"failedEventIds":["e","v1","v2"]'
                  WHEN k < 2 THEN ',"failedEventIds":["v2"]' ELSE '' END AS ids FROM kept)
    SELECT uid, CASE WHEN spec THEN 'immediate' ELSE 'batch' END AS route,
      CASE WHEN uid LIKE '%a' THEN concat('[{{"propertyName":"k","propertyType":"', shape, '"', ids, '}},{{"propertyName":"j","propertyType":"int"}}]')
           ELSE concat('[{{"propertyName":"j","propertyType":"int"}},{{"propertyName":"k","propertyType":"', shape, '"', ids, '}}]') END AS document
    FROM ided""",
)
def inspect_events_query(spark, sf):
    reports = _reports(spark, sf)
    spec = {"k": prop(minmax={"0,50": ["e", "v1"], "2,": ["v2"]})}
    specs = same_spec(reports, wire(spec, ids=["e", "v1", "v2", "v3", "v4", "v5"])).filter("event_name IN ('click', 'view')")
    inspected = inspect_events(reports, load_specs(specs, ["event_name"]), App())
    return inspected.select("uid", "route", "document")


# the same inspections with identities over what was kept, and with their bodies
_INSPECTED_SQL = f"""{_REPORTS_SQL}, {_replay_sql('tagged')},
kept AS (SELECT t.* FROM fold f JOIN tagged t ON t.uid = f.uid WHERE f.rn > 0 AND NOT dup),
seen AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS rn FROM kept),
ids AS (
  SELECT client_id, uid, rn, ms AS last_ms, ms AS created FROM seen WHERE rn = 1
  UNION ALL
  SELECT r.client_id, r.uid, r.rn, r.ms,
         CASE WHEN r.ms - i.created > 14400000 AND r.ms - i.last_ms > 7200000 THEN r.ms ELSE i.created END
  FROM ids i JOIN seen r ON r.client_id = i.client_id AND r.rn = i.rn + 1),
documented AS (
  SELECT s.*, s.source = 'codegen' AS coded, s.event_name IN ('click', 'view') AS spec, sha256(concat('message|', s.uid)) AS m,
    sha256(concat(s.client_id, '|', i.created)) AS h,
    CASE WHEN s.event_name NOT IN ('click', 'view') THEN '' WHEN str THEN ',"failedEventIds":["e","v1","v2"]'
         WHEN k < 2 THEN ',"failedEventIds":["v2"]' ELSE '' END AS ids
  FROM seen s JOIN ids i ON i.uid = s.uid),
bodies AS (
  SELECT uid, client_id, ms, spec, {_body_sql(
      "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))",
      "CASE WHEN uid LIKE '%a' THEN concat('[{\"propertyName\":\"k\",\"propertyType\":\"', shape, '\"', ids, '}},{\"propertyName\":\"j\",\"propertyType\":\"int\"}]') "
      "ELSE concat('[{\"propertyName\":\"j\",\"propertyType\":\"int\"},{\"propertyName\":\"k\",\"propertyType\":\"', shape, '\"', ids, '}}]') END".replace("}}", "}"),
      _EVENT_TAIL.removesuffix(", '}}'")
      + ", CASE WHEN spec THEN ',\"eventSpecMetadata\":{{\"schemaId\":\"schema-1\",\"branchId\":\"main\",\"latestActionId\":\"a1\"}},"
      "\"validatedBranchId\":\"main\"' ELSE '' END, '}}'",
  )} AS body FROM documented)
"""


def _inspected(spark, sf):
    reports = _reports(spark, sf)
    spec = {"k": prop(minmax={"0,50": ["e", "v1"], "2,": ["v2"]})}
    specs = same_spec(reports, wire(spec, ids=["e", "v1", "v2", "v3", "v4", "v5"])).filter("event_name IN ('click', 'view')")
    return inspect_events(reports, load_specs(specs, ["event_name"]), App())


@query("inspect_bodies", f"WITH RECURSIVE {_INSPECTED_SQL} SELECT uid, md5(body) AS body FROM bodies")
def inspect_bodies(spark, sf):
    """Whole bodies of an inspection: identities, documents with results, metadata of the specification."""
    return _inspected(spark, sf).select("uid", F.md5("body").alias("body"))


@query(
    "outgoing_requests",
    f"""WITH RECURSIVE {_INSPECTED_SQL},
    waiting AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY ms, uid) AS wn FROM bodies WHERE NOT spec),
    queued AS (
      SELECT client_id, 0::BIGINT AS wn, 0 AS n, ms AS flushed_ms, 'start' AS flushed, NULL::VARCHAR AS uid, NULL::VARCHAR AS after FROM waiting WHERE wn = 1
      UNION ALL
      SELECT client_id, wn, CASE WHEN f THEN 0 ELSE n + 1 END, CASE WHEN f THEN ms ELSE flushed_ms END, CASE WHEN f THEN uid ELSE flushed END, uid, flushed
      FROM (SELECT r.*, o.n, o.flushed_ms, o.flushed, (o.n + 1) % {_SIZE} = 0 OR r.ms - o.flushed_ms >= {_SECONDS * 1000} AS f
            FROM queued o JOIN waiting r ON r.client_id = o.client_id AND r.wn = o.wn + 1)),
    batched AS (SELECT b.*, CASE WHEN b.spec THEN concat('event|', b.uid) ELSE concat(q.client_id, '|', q.after) END AS batch_id FROM bodies b LEFT JOIN queued q ON q.uid = b.uid),
    r AS (SELECT batch_id, count(*) AS n_events, concat('[', string_agg(body, ',' ORDER BY ms, uid), ']') AS request FROM batched GROUP BY 1)
    SELECT batch_id, CAST(n_events AS INT) AS n_events, md5(request) AS request, length(request) >= 1024 AS gzip FROM r""",
)
def outgoing_requests_query(spark, sf):
    """The outgoing half: validated events one by one, the rest in batches."""
    requests = outgoing_requests(_inspected(spark, sf), size=_SIZE, seconds=_SECONDS)
    return requests.select("batch_id", "n_events", F.md5("request").alias("request"), "gzip")


@query(
    "inspect_schemas",
    f"WITH RECURSIVE {_SHAPED_SQL}, {_replay_sql('mixed')} SELECT f.uid, a.shape FROM fold f JOIN asked a ON a.uid = f.uid WHERE NOT dup",
)
def inspect_schemas_query(spark, sf):
    kept = inspect_schemas(_asked(spark, sf), _reports(spark, sf), App())
    shape = F.get_json_object("body", "$.eventProperties[0].propertyType")
    return kept.select("uid", shape.alias("shape"))


@query(
    "extract_only",
    f"""WITH {_REPORTS_SQL}
    SELECT uid, EXISTS (SELECT 1 FROM tagged c WHERE c.source = 'codegen' AND c.client_id = t.client_id AND c.params = t.params
                        AND t.ms - c.ms BETWEEN 0 AND 300) AS seen_by_codegen,
      CASE WHEN uid LIKE '%a' THEN concat('[{{"propertyName":"k","propertyType":"', shape, '"}},{{"propertyName":"j","propertyType":"int"}}]')
           ELSE concat('[{{"propertyName":"j","propertyType":"int"}},{{"propertyName":"k","propertyType":"', shape, '"}}]') END AS document
    FROM tagged t WHERE source = 'manual'""",
)
def extract_only_query(spark, sf):
    reports = _reports(spark, sf)
    return extract_only(reports.filter("source = 'manual'"), reports).select("uid", "seen_by_codegen", "document")


@query(
    "production_profile",
    f"""WITH RECURSIVE {_BATCH_SQL},
    m AS (SELECT b.*, q.ms, q.n % 2 = 1 AS coded, e.event_type AS event_name, sha256(concat('message|', b.uid)) AS m
          FROM batched b JOIN queue q USING (uid) JOIN events e ON e.event_id = q.n),
    bodies AS (SELECT batch_id, ms, uid, {_body_sql("''", _K_DOCUMENT, _EVENT_TAIL, rate="0.8")} AS body FROM m),
    r AS (SELECT batch_id, count(*) AS n_events, concat('[', string_agg(body, ',' ORDER BY ms, uid), ']') AS request FROM bodies GROUP BY 1)
    SELECT batch_id, CAST(n_events AS INT) AS n_events, md5(request) AS request, length(request) >= 1024 AS gzip FROM r
    WHERE NOT (CAST(concat('0x', substr(md5(batch_id), 1, 8)) AS BIGINT) / 4294967295.0 > 0.8)""",
)
def production_profile_query(spark, sf):
    coded = F.col("n") % 2 == 1
    rows = _queue(spark, sf).withColumns(
        {"event_id": F.when(coded, F.concat(F.lit("evt-"), "event_name")), "event_hash": F.lit("h1")}
    )
    requests = production_profile(rows, App(), rate=0.8, size=_SIZE, seconds=_SECONDS)
    return requests.select("batch_id", "n_events", F.md5("request").alias("request"), "gzip")
