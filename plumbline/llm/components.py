"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import few_tasks, settle

#: links that one task of a pass reads
ROWS_PER_TASK = 250_000


def connected_components(links: DataFrame) -> DataFrame:
    """node, label for every node of ``links`` (a, b); the label is the component's smallest node.

    Each pass replaces links by links to smaller nodes and is checkpointed; passes grow with
    the logarithm of a component's size.  A node with many neighbours is a partial minimum and
    a join that adaptive execution splits, never a list.
    """
    edges = few_tasks(settle(_both(links.filter("a <> b")).filter("u > v").distinct()))
    state = _state(edges)
    while True:
        tasks = max(1, state[0] // ROWS_PER_TASK)
        # large star: larger neighbours of a node link to the smallest around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")).coalesce(tasks)
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks))
        # small star: a node and its smaller neighbours link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        edges = settle(small.coalesce(tasks).distinct().coalesce(tasks))
        before, state = state, _state(edges)
        if state == before:
            break
    labelled = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labelled.unionByName(labelled.select("label").distinct().select(F.col("label").alias("node"), "label"))


def _state(edges: DataFrame) -> tuple:
    """Number and hash sum of distinct links: equal when nothing has changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _both(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
