"""Tables are spread evenly over tasks, however their files are cut."""

import tempfile

from pyspark.sql import functions as F

from plumbline.catalog import inputs


def _stored(spark, rows):
    folder = tempfile.mkdtemp(prefix="plumbline-table-")
    spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1).write.parquet(f"{folder}/t.parquet")
    return folder


def _sizes(df):
    counts = df.groupBy(F.spark_partition_id()).count().collect()
    return [r["count"] for r in counts]


def test_one_row_group_in_many_splits_is_spread(spark):
    """One group of rows went to one task, as the file had enough splits."""
    folder, name = _stored(spark, 40_000), "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "100000")
    try:
        assert spark.read.parquet(f"{folder}/t.parquet").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        found = inputs.table(spark, folder, "t")
        sizes = _sizes(found)
    finally:
        spark.conf.set(name, before)
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * 40_000 / spark.sparkContext.defaultParallelism


def test_tasks_grow_with_the_table(spark):
    cores = spark.sparkContext.defaultParallelism
    small, large = _stored(spark, 1_000), _stored(spark, 1_000 * 60)
    assert inputs.tasks_for(spark, f"{small}/t.parquet") == cores
    each = inputs.stored_bytes(spark, f"{large}/t.parquet") // (10 * cores)
    assert inputs.tasks_for(spark, f"{large}/t.parquet", each) >= 10 * cores


def test_tasks_grow_with_rows_that_take_few_bytes(spark):
    """A hundred times the rows of few values take hardly more bytes, and went to as many tasks."""
    folder = tempfile.mkdtemp(prefix="plumbline-table-")
    spark.range(60_000).select((F.col("id") % 2).alias("flag")).coalesce(1).write.parquet(f"{folder}/t.parquet")
    assert inputs.stored_bytes(spark, f"{folder}/t.parquet") < 60_000
    assert inputs.tasks_for(spark, f"{folder}/t.parquet", rows=1_000) == 60


def test_lines_of_orders_are_never_broadcast(spark):
    """Stored bytes made the planner send the lines of all orders to every task."""
    folder = tempfile.mkdtemp(prefix="plumbline-orders-")
    key = F.col("id").alias("o_orderkey")
    orders = spark.range(50).select(key, *[F.lit("x").alias(f"o_{c}") for c in ("orderstatus", "orderpriority")], F.lit(1.5).alias("o_totalprice"),
                                    F.lit(7).alias("o_custkey"), F.lit("2024-01-01").alias("o_orderdate"))
    numbers = [F.lit(1).alias(f"l_{c}") for c in ("partkey", "suppkey")]
    lines = spark.range(100).select((F.col("id") % 25).alias("l_orderkey"), F.col("id").alias("l_linenumber"), *numbers,
                                    F.lit(2.0).alias("l_quantity"), F.lit(3.5).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"))
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    events = inputs.order_events(spark, folder)
    assert "BroadcastHashJoin" not in events._jdf.queryExecution().executedPlan().toString()
    found = {r["uid"]: r["props"].count('"qty"') for r in events.collect()}
    assert found == {f"o{i}": 4 if i < 25 else 0 for i in range(50)}
