"""Keeping large expressions from being computed twice.

The optimizer pushes filters through projections by copying the expressions they
name, and derives a filter from every inner ``explode``.  With a whole document
behind a column, each copy costs a full parse.  A generator is a boundary for
both, and the outer forms derive nothing.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def pin(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that later steps refer to but never copy."""
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def unnest(df: DataFrame, keys: list[str], array: Column, name: str) -> DataFrame:
    """One row per element; rows with an empty or NULL array go."""
    rows = df.select(*keys, F.posexplode_outer(array).alias(f"_{name}_pos", name))
    return rows.filter(F.col(f"_{name}_pos").isNotNull()).drop(f"_{name}_pos")


BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Where none is set, as in tests, a temporary one serves a local session; a cluster must name
    one that its executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="plumbline-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, through the session's checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(settled: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a settled table whose values take few bytes; leave any other to a shuffle join."""
    width = F.lit(0)
    for name in settled.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16
    size = settled.agg(F.sum(width).alias("n")).first()["n"] or 0
    return F.broadcast(settled) if size <= most else settled
