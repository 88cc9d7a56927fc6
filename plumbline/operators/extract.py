"""Schema extraction from property objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.deep import nodes_in
from plumbline.functions.documents import (
    SEAL_KEY,
    add_schema_document,
    drop_levels,
    open_levels,
    schema_nodes,
)

from plumbline.functions.planning import unnest
from plumbline.functions.values import each

#: levels opened by column expressions where nothing is validated; each further one costs more than the helper
OPENED = 1


def property_types(df: DataFrame, keys: list[str], raw: str = "props") -> DataFrame:
    """Top-level properties with their observed types (B1)."""
    opened = open_levels(df, raw, max_depth=1)
    rows = opened.select(*keys, F.posexplode_outer("_level0").alias("ord", "m")).filter("ord is not null")
    return rows.select(*keys, "ord", "m.name", "m.type")


def extract_schema(df: DataFrame, keys: list[str], raw: str = "props", max_depth: int = OPENED) -> DataFrame:
    """All properties at every level as rows (B2), lists with their scalar types.

    Values deeper than ``max_depth`` levels are followed by an Arrow helper, so
    no property is left out.
    """
    nodes = unnest(open_levels(df, raw, max_depth=max_depth), keys, schema_nodes(max_depth=max_depth), "n")
    deep = nodes.withColumn("_deep", nodes_in(F.col("n.fenced")))
    below = each(
        "slice(_deep, 2, size(_deep))",
        lambda d, _: f"named_struct('path', concat(n.path, {d}.path), 'name', {d}.name, 'type', {d}.type, "
        f"'ord', {d}.ord, 'list_types', {d}.list_types)",
    )
    # the helper gives the value itself first
    types = "coalesce(n.list_types, get(_deep, 0).list_types)"
    own = f"named_struct('path', n.path, 'name', n.name, 'type', n.type, 'ord', n.ord, 'list_types', {types})"
    rows = F.expr(f"CASE WHEN _deep IS NULL THEN array({own}) ELSE concat(array({own}), {below}) END")
    return (
        unnest(deep, keys, rows, "r")
        .filter(F.col("r.name").isNotNull())
        .select(*keys, "r.path", (F.size("r.path") - 1).alias("depth"), "r.ord", "r.name", "r.type", "r.list_types")
    )


def extract_document(
    df: DataFrame, raw: str = "props", out: str = "document", seal: Sealer | None = None
) -> DataFrame:
    """Nested schema document per event."""
    opened = open_levels(df, raw, max_depth=OPENED)
    return drop_levels(add_schema_document(opened, out, seal=seal, max_depth=OPENED))


class Sealer:
    """Encryption of scalar values (B5) with a key that no plan shows.

    The key is the only row of a table that executors get as data, so neither the plan nor the
    event log holds it; the expressions name its column.
    """

    def __init__(self, key: str):
        self._key = key

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the key's column: one row, sent to all tasks."""
        spark = df.sparkSession
        key = spark.createDataFrame(spark.sparkContext.parallelize([(self._key,)], 1), f"{SEAL_KEY} string")
        return df.join(F.broadcast(key))

    def __call__(self, text: str) -> str:
        return f"base64(aes_encrypt({text}, {SEAL_KEY}, 'GCM', 'DEFAULT'))"


def sealer(key: str, env: str) -> Sealer | None:
    """Encryption of scalar values (B5): only in dev and staging, and only with a key.

    Values are sealed with AES-GCM as base64 text and never leave in the clear.
    """
    if env not in ("dev", "staging") or not key:
        return None
    if len(key.encode()) not in (16, 24, 32):
        raise ValueError("the key must have 16, 24 or 32 bytes")
    return Sealer(key)


def unseal(value: Column, key: str) -> Column:
    """JSON text of a sealed value; NULL when it cannot be opened."""
    return F.try_aes_decrypt(F.unbase64(value), F.lit(key), F.lit("GCM"), F.lit("DEFAULT")).cast("string")
