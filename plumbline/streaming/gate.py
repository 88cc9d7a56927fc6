"""First half of a stream that keeps everything: late rows, rejects, and the specifications in force.

Spark drops rows behind the watermark in front of a stateful operator.  The gate stands before
it and keeps its own event time: of each micro-batch the rows that are older than the delay allows
go to a side table, and what is left is read again as a stream, which drops nothing, as
its watermark never runs ahead of the gate's.  Every micro-batch is written once, under its
number: ``kept``, ``late`` and ``rejects``, then a mark with the event time reached.

What is stateless is done here too, by a function of the micro-batch.  So each one is
validated against the specifications that are in force when it arrives (``LiveSpecs``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from plumbline.functions.planning import pin
from plumbline.sources.commit import as_parquet, exists, name_staged, write_once
from plumbline.sources.events import accept_events
from plumbline.sources.specs import SpecTable, load_specs

PARTS = ("kept", "late", "rejects")
_MS = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


class LiveSpecs:
    """Specifications that may change while a stream runs.

    ``read`` gives the table of documents anew; it is compiled again only when its content differs.
    """

    def __init__(self, read: Callable[[], DataFrame], keys: list[str], order: str | None = None):
        self.read, self.keys, self.order = read, keys, order
        self.content: tuple | None = None
        self.table: SpecTable | None = None

    def current(self) -> SpecTable:
        documents = self.read()
        hashed = F.xxhash64(*documents.columns).cast("decimal(38,0)")
        content = tuple(documents.agg(F.count("*"), F.sum(hashed)).first())
        if content != self.content:
            self.table = load_specs(documents, self.keys, order=self.order)
            self.content = content
        return self.table


def delay_ms(delay: str) -> int:
    """Milliseconds of a delay like ``10 minutes``."""
    number, unit = delay.split()
    return int(number) * _MS[unit.rstrip("s")]


def is_late(ts: Column, reached_ms: Column, delay: str) -> Column:
    """At or behind the watermark that event time ``reached_ms`` leaves; the same rule as Spark's."""
    return F.coalesce(F.unix_micros(ts) <= (reached_ms - delay_ms(delay)) * 1000, F.lit(False))


def _name(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def _reached(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """Largest event time up to a micro-batch."""
    if batch_id < 0:
        return None
    return spark.read.parquet(f"{folder}/marks/{_name(batch_id)}").first()["reached_ms"]


def pass_gate(batch: DataFrame, batch_id: int, folder: str, delay: str, prepare: Callable[[DataFrame], DataFrame] | None = None, props: str | None = "props") -> None:
    """Write the parts of one micro-batch under its number, unless that was done.

    A row is late if it is older than the delay allows, measured from the event time that the
    micro-batches before reached.  Rows whose property text is not one JSON object, or that have no
    time, are rejects.  ``prepare`` turns the rows that are kept into those that are written.
    """
    spark = batch.sparkSession
    if exists(spark, f"{folder}/marks/{_name(batch_id)}"):
        return
    before = _reached(spark, folder, batch_id - 1)
    late = is_late(F.col("ts"), F.lit(before).cast("long"), delay)
    good = accept_events(batch, props) if props else batch.withColumn("accepted", F.lit(True))
    part = F.when(F.col("ts").isNull() | ~F.col("accepted"), "rejects").when(late, "late").otherwise("kept")
    sorted_out = pin(good, "_part", part).drop("accepted")
    seen = Observation()
    staged = f"{folder}/.staged/{_name(batch_id)}"
    watched = sorted_out.observe(seen, F.max(F.when(F.col("_part") != "rejects", F.unix_millis("ts"))).alias("ms"))
    watched.write.mode("overwrite").partitionBy("_part").parquet(staged)
    for name in PARTS:
        rows = f"{staged}/_part={name}"
        if name == "kept" and prepare is not None:
            if exists(spark, rows):
                ready = prepare(spark.read.schema(batch.schema).parquet(rows))
                write_once(ready, f"{folder}/kept", _name(batch_id), as_parquet)
        else:
            name_staged(spark, rows, f"{folder}/{name}/{_name(batch_id)}")
    reached = max((t for t in (before, seen.get["ms"]) if t is not None), default=None)
    mark = spark.createDataFrame([(batch_id, reached)], "batch_id long, reached_ms long").coalesce(1)
    write_once(mark, f"{folder}/marks", _name(batch_id), as_parquet)


def gate(events: DataFrame, folder: str, delay: str, prepare: Callable[[DataFrame], DataFrame] | None = None, props: str | None = "props") -> DataStreamWriter:
    """The gate as a sink of ``events``; start it with a checkpoint location and a trigger."""
    return events.writeStream.foreachBatch(lambda batch, batch_id: pass_gate(batch, batch_id, folder, delay, prepare, props))


def read_part(spark: SparkSession, folder: str, part: str, schema) -> DataFrame:
    """All rows of a part so far."""
    if not exists(spark, f"{folder}/{part}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/{part}")


def stream_kept(spark: SparkSession, folder: str, schema, delay: str) -> DataFrame:
    """What passed the gate, as a stream with its watermark; none of it is late.

    ``delay`` must not be shorter than the gate's.  A trigger takes all there is: were a
    micro-batch of the gate cut over two, its own first half could make the second one late.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFileAge", "3650d")
    return reader.parquet(f"{folder}/kept").withWatermark("ts", delay)


def finish(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Run over all that is there now, and wait."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query
