"""Writes that may be repeated: a result is staged in a hidden folder and then gets its name, once.

A name that is there is complete, so a job or a micro-batch that runs again after a failure
finds it and writes nothing.  The rename is atomic on HDFS and local folders; on a store without
renames it copies, and a reader must wait for the writer's commit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Length of a file, or of all files of a folder."""
    files, place = _hadoop(spark, path)
    return files.getContentSummary(place).getLength()


def name_staged(spark: SparkSession, staged: str, target: str) -> None:
    """Give a staged folder its name; one that was named before stays as it is."""
    files, source = _hadoop(spark, staged)
    if not files.exists(source):
        return
    _, place = _hadoop(spark, target)
    if files.exists(place):
        files.delete(source, True)
        return
    files.mkdirs(place.getParent())
    if not files.rename(source, place):
        raise OSError(f"can't rename {staged} to {target}")


def write_once(df: DataFrame, folder: str, name: str, write: Callable[[DataFrame, str], None]) -> bool:
    """Write ``df`` as ``folder/name`` unless that is there; says whether it wrote."""
    spark, target, staged = df.sparkSession, f"{folder}/{name}", f"{folder}/.staged/{name}"
    if exists(spark, target):
        return False
    write(df, staged)
    name_staged(spark, staged, target)
    return True


def as_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
