"""A stream in several micro-batches gives what the batch operators give."""

import tempfile

from pyspark.sql import functions as F

from plumbline.catalog.flow import _asked, _reports, _visits
from plumbline.operators.batching import assign_batches
from plumbline.operators.dedup import dedup_events
from plumbline.operators.identity import assign_stream_id
from plumbline.operators.envelope import App
from plumbline.plans.inspect import inspect_events, inspect_schemas, validate_documents
from plumbline.sources.specs import load_specs
from plumbline.streaming.inspect import _Inspect, inspect_schemas_stream, inspect_stream
from plumbline.streaming.stateful import _Dedup, _Identity, batch_stream, dedup_stream, identify_stream, write_routed

SF = "/root/testdata/sf0.001"


def _run(spark, rows, transform, columns, more=()):
    """Stream ``rows`` in time order, three files and one far-future row to move the watermark."""
    source = tempfile.mkdtemp(prefix="plumbline-in-")
    fields = "uid string, client_id string, event_name string, source string, props string, ts timestamp"
    fields += "".join(f", {c} string" for c in more)
    rows = rows.select("uid", "client_id", "event_name", "source", "props", "ts", *more).orderBy("ts").toPandas()
    last = rows.iloc[[-1]].assign(uid="last", client_id="nobody", ts=rows["ts"].max() + __import__("pandas").Timedelta(days=2))
    cut = len(rows) // 3
    for part in (rows[:cut], rows[cut : 2 * cut], rows[2 * cut :], last, last.assign(uid="end")):
        spark.createDataFrame(part, fields).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(source).withWatermark("ts", "1 second")
    )
    name = f"out_{transform.__name__}"
    query = (
        transform(stream).writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="plumbline-cp-")).trigger(availableNow=True).start()
    )
    query.awaitTermination(300)
    return {tuple(r) for r in spark.table(name).select(*columns).collect() if r[0] not in ("last", "end")}


def test_dedup(spark):
    rows = _reports(spark, SF).filter("n < 400")
    expected = {tuple(r) for r in dedup_events(rows).select("uid").collect()}
    assert 0 < len(expected) < rows.count()
    assert _run(spark, rows, dedup_stream, ["uid"]) == expected


def test_identity(spark):
    rows = _visits(spark, SF).filter("n < 400").withColumn("source", F.lit("manual"))
    expected = {tuple(r) for r in assign_stream_id(rows).select("uid", "stream_id").collect()}
    assert _run(spark, rows, identify_stream, ["uid", "stream_id"]) == expected


def test_batches(spark):
    rows = _reports(spark, SF).filter("n < 400")
    expected = {tuple(r) for r in assign_batches(rows).select("uid", "batch_id", "flush").collect()}
    assert _run(spark, rows, batch_stream, ["uid", "batch_id", "flush"]) == expected


def _specs(rows):
    from plumbline.catalog.inputs import prop, same_spec, wire

    return load_specs(same_spec(rows, wire({"k": prop(minmax={"0,2": ["e"]})})).filter("event_name = 'click'"), ["event_name"])


def test_whole_inspection(spark):
    rows = _reports(spark, SF).filter("n < 300").withColumn("client_id", F.when(F.col("n") % 9 != 0, F.col("client_id")))
    specs, columns = _specs(rows), ["uid", "route", "stream_id", "document", "body"]
    expected = {tuple(r) for r in inspect_events(rows.filter("client_id IS NOT NULL"), specs, App()).select(*columns).collect()}

    def inspect(stream):
        return inspect_stream(stream.filter("client_id IS NOT NULL"), specs, App())

    assert _run(spark, rows, inspect, columns, more=["event_id", "event_hash"]) == expected


def test_schema_inspection(spark):
    reports = _reports(spark, SF).filter("n < 300")
    asked = _asked(spark, SF).filter("uid < '0000000300'")
    expected = {tuple(r) for r in inspect_schemas(asked, reports, App()).select("uid", "body").collect()}
    assert 0 < len(expected) < asked.count()
    mixed = reports.withColumn("schema_json", F.lit(None).cast("string")).unionByName(
        asked.withColumns({"source": F.lit("schema"), "props": F.lit(None).cast("string")}), allowMissingColumns=True
    )

    def schemas(stream):
        return inspect_schemas_stream(stream, App())

    assert _run(spark, mixed, schemas, ["uid", "body"], more=["schema_json"]) == expected


def test_state_ends():
    """What a silent client leaves behind is cleared: its memory has an end that the watermark passes."""
    start = 1704067200000
    dedup, identity, whole = _Dedup(), _Identity(), _Inspect()
    _, memory = dedup.replay(("c",), [(start, "u", "manual|p")], None)
    assert dedup.end_of(memory) == start + 300
    _, memory = identity.replay(("c",), [(start, "u", ""), (start + 10_000_000, "v", "")], None)
    assert identity.end_of(memory) == start + 10_000_000 + 2 * 3_600_000
    row = '{"event_name":"x","source":"manual","params":"p","shape":null,"identified":true,"payload":"{}"}'
    _, memory = whole.replay(("c",), [(start, "u", row)], None)
    assert whole.end_of(memory) == start + 4 * 3_600_000
    assert whole.end_of(({}, None, None)) == 0


def test_routed_documents(spark):
    from plumbline.catalog.inputs import prop, same_spec, wire

    source, out = tempfile.mkdtemp(prefix="plumbline-in-"), tempfile.mkdtemp(prefix="plumbline-out-")
    rows = _reports(spark, SF).select("uid", "event_name", "props")
    rows.repartition(3).write.mode("append").parquet(source)
    specs = load_specs(
        same_spec(rows, wire({"k": prop(minmax={"0,2": ["e"]})})).filter("event_name = 'click'"), ["event_name"]
    )
    stream = spark.readStream.schema(rows.schema).parquet(source)
    write_routed(validate_documents(stream, specs), out, tempfile.mkdtemp(prefix="plumbline-cp-")).awaitTermination(300)
    expected = {tuple(r) for r in validate_documents(rows, specs).select("uid", "route", "document").collect()}
    assert {tuple(r) for r in spark.read.parquet(out).select("uid", "route", "document").collect()} == expected
