"""Raw events (A1) and pre-extracted schemas (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "uid string, client_id string, event_name string, ts timestamp, source string, "
    "event_id string, event_hash string, props string"
)
SCHEMA_ROW = "struct<propertyName:string,propertyType:string,encryptedPropertyValue:string,children:variant>"


def read_events(spark: SparkSession, path: str, format: str = "parquet", streaming: bool = False) -> DataFrame:
    """Raw tracking calls with the property object as JSON text.

    A streaming source must be a directory.
    """
    reader = (spark.readStream if streaming else spark.read).schema(EVENT_SCHEMA).format(format)
    return reader.load(path)


def accept_events(df: DataFrame, props: str = "props") -> DataFrame:
    """Add ``accepted``: the property text is absent or holds one JSON object and nothing else.

    The parser stops where a value ends.  Text that goes on behind it breaks at least one of an
    array and an object put around it, or gives the array a second element.
    """
    parsed = lambda text: F.try_parse_json(text)
    is_object = F.schema_of_variant(parsed(F.col(props))).startswith("OBJECT")
    listed = F.try_variant_get(parsed(F.concat(F.lit("["), props, F.lit("]"))), "$", "array<variant>")
    alone = (F.size(listed) == 1) & parsed(F.concat(F.lit('{"x":'), props, F.lit("}"))).isNotNull()
    return df.withColumn("accepted", F.col(props).isNull() | F.coalesce(is_object & alone, F.lit(False)))


def split_rejects(df: DataFrame, props: str = "props") -> tuple[DataFrame, DataFrame]:
    """Accepted events, and the reject table for repair."""
    marked = accept_events(df, props)
    return marked.filter("accepted").drop("accepted"), marked.filter("not accepted").drop("accepted")


def read_schemas(df: DataFrame, text: str = "schema_json") -> DataFrame:
    """Open pre-extracted schema documents: ``schema`` holds one struct per property."""
    return df.withColumn("schema", F.from_json(text, f"array<{SCHEMA_ROW}>"))
