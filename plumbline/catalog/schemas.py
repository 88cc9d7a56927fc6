"""Queries on reading events and extracting schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import query
from plumbline.catalog.inputs import EVENTS_SQL, ORDERS_SQL, order_events, rich_events, table
from plumbline.operators.dedup import schema_fingerprint
from plumbline.operators.extract import extract_document, extract_schema, property_types, sealer, unseal
from plumbline.sources.events import accept_events, read_schemas

_DAMAGE = """CASE event_id % 8 WHEN 0 THEN substr(props, 1, length(props) - 1) WHEN 1 THEN '[1]'
                  WHEN 2 THEN NULL ELSE props END"""


@query(
    "read_events",
    f"""WITH e AS (SELECT event_id, {_DAMAGE} AS props FROM events)
    SELECT event_id, props IS NULL OR coalesce(CASE WHEN json_valid(props) THEN json_type(props) = 'OBJECT' END, false) AS accepted
    FROM e""",
)
def read_events_query(spark, sf):
    damaged = table(spark, sf, "events").select("event_id", F.expr(_DAMAGE).alias("props"))
    return accept_events(damaged).select("event_id", "accepted")


_TYPES_SQL = f"""
{EVENTS_SQL},
types AS (
  SELECT uid, 'k' AS name, 'int' AS type FROM ev
  UNION ALL SELECT uid, 'value', CASE WHEN value = floor(value) THEN 'int' ELSE 'float' END FROM ev
  UNION ALL SELECT uid, 'label', 'string' FROM ev
  UNION ALL SELECT uid, 'flag', CASE WHEN flag = 'null' THEN 'null' ELSE 'boolean' END FROM ev WHERE flag IS NOT NULL
  UNION ALL SELECT uid, 'code', CASE n % 5 WHEN 0 THEN 'string' WHEN 1 THEN 'int' WHEN 2 THEN 'boolean'
                                           WHEN 3 THEN 'null' ELSE 'list' END FROM ev
  UNION ALL SELECT uid, 'tags', 'list' FROM ev
  UNION ALL SELECT uid, 'geo', CASE WHEN n % 6 = 0 THEN 'null' ELSE 'object' END FROM ev)
"""


@query("property_types", f"WITH {_TYPES_SQL} SELECT uid, name, type FROM types")
def property_types_query(spark, sf):
    return property_types(rich_events(spark, sf), ["uid"]).select("uid", "name", "type")


@query(
    "extract_schema",
    f"""WITH {_TYPES_SQL}
    SELECT uid, name AS path, 0 AS depth, type FROM types
    UNION ALL SELECT uid, 'geo.city', 1, CASE WHEN n % 4 = 3 THEN 'null' ELSE 'string' END FROM ev WHERE n % 6 <> 0
    UNION ALL SELECT uid, 'geo.zip', 1, 'int' FROM ev WHERE n % 6 <> 0
    UNION ALL SELECT uid, 'geo.in', 1, 'object' FROM ev WHERE n % 6 <> 0
    UNION ALL SELECT uid, 'geo.in.x', 2, 'int' FROM ev WHERE n % 6 <> 0""",
)
def extract_schema_query(spark, sf):
    rows = extract_schema(rich_events(spark, sf), ["uid"])
    return rows.select("uid", F.array_join("path", ".").alias("path"), "depth", "type")


_ORDER_NODES = f"""WITH {ORDERS_SQL},
kind AS (SELECT l_orderkey, pos, CASE WHEN l_extendedprice = floor(l_extendedprice) THEN 'int' ELSE 'float' END AS price,
                CASE WHEN l_quantity = floor(l_quantity) THEN 'int' ELSE 'float' END AS qty FROM items)
SELECT uid, 'status' AS path, 0 AS depth, 'string' AS type FROM ord
UNION ALL SELECT uid, 'total', 0, CASE WHEN o_totalprice = floor(o_totalprice) THEN 'int' ELSE 'float' END FROM ord
UNION ALL SELECT uid, 'customer', 0, 'object' FROM ord
UNION ALL SELECT uid, 'customer.id', 1, 'int' FROM ord
UNION ALL SELECT uid, 'customer.priority', 1, 'string' FROM ord
UNION ALL SELECT uid, 'items', 0, 'list' FROM ord
UNION ALL SELECT concat('o', l_orderkey), concat('items.', pos, '.part'), 2, 'int' FROM kind
UNION ALL SELECT concat('o', l_orderkey), concat('items.', pos, '.qty'), 2, qty FROM kind
UNION ALL SELECT concat('o', l_orderkey), concat('items.', pos, '.price'), 2, price FROM kind
UNION ALL SELECT concat('o', l_orderkey), concat('items.', pos, '.flag'), 2, 'string' FROM kind"""


@query("extract_schema_nested", _ORDER_NODES)
def extract_schema_nested(spark, sf):
    rows = extract_schema(order_events(spark, sf), ["uid"])
    return rows.select("uid", F.array_join("path", ".").alias("path"), "depth", "type")


@query("extract_schema_deep", _ORDER_NODES)
def extract_schema_deep(spark, sf):
    """The same rows when the walk stops after one level and the helper takes over."""
    rows = extract_schema(order_events(spark, sf), ["uid"], max_depth=1)
    return rows.select("uid", F.array_join("path", ".").alias("path"), "depth", "type")


@query(
    "list_element_types",
    f"""WITH {EVENTS_SQL}
    SELECT uid, 'tags' AS name, CASE n % 3 WHEN 0 THEN '' WHEN 1 THEN 'string,int,float,boolean' ELSE 'int,string' END AS types FROM ev
    UNION ALL SELECT uid, 'code', 'int,string' FROM ev WHERE n % 5 = 4""",
)
def list_element_types(spark, sf):
    rows = extract_schema(rich_events(spark, sf), ["uid"]).filter("type = 'list'")
    return rows.select("uid", "name", F.array_join("list_types", ",").alias("types"))


_ORDER_DOCUMENT = f"""WITH {ORDERS_SQL},
kind AS (SELECT l_orderkey, pos,
    concat('[{{"propertyName":"part","propertyType":"int"}},{{"propertyName":"qty","propertyType":"',
      CASE WHEN l_quantity = floor(l_quantity) THEN 'int' ELSE 'float' END,
      '"}},{{"propertyName":"price","propertyType":"', CASE WHEN l_extendedprice = floor(l_extendedprice) THEN 'int' ELSE 'float' END,
      '"}},{{"propertyName":"flag","propertyType":"string"}}]') AS item FROM items),
lists AS (SELECT l_orderkey, string_agg(item, ',' ORDER BY pos) AS list FROM kind GROUP BY l_orderkey),
docs AS (SELECT uid, concat('[{{"propertyName":"status","propertyType":"string"}},{{"propertyName":"total","propertyType":"',
      CASE WHEN o_totalprice = floor(o_totalprice) THEN 'int' ELSE 'float' END,
      '"}},{{"propertyName":"customer","propertyType":"object","children":[{{"propertyName":"id","propertyType":"int"}},',
      '{{"propertyName":"priority","propertyType":"string"}}]}},{{"propertyName":"items","propertyType":"list","children":[',
      coalesce(list, ''), ']}}]') AS document FROM ord LEFT JOIN lists ON l_orderkey = o_orderkey)
"""


@query("schema_document", _ORDER_DOCUMENT + "SELECT uid, document FROM docs")
def schema_document_query(spark, sf):
    return extract_document(order_events(spark, sf)).select("uid", "document")


@query(
    "read_schemas",
    _ORDER_DOCUMENT
    + """SELECT uid, name, type FROM (
      SELECT uid, 'status' AS name, 'string' AS type FROM ord
      UNION ALL SELECT uid, 'total', CASE WHEN o_totalprice = floor(o_totalprice) THEN 'int' ELSE 'float' END FROM ord
      UNION ALL SELECT uid, 'customer', 'object' FROM ord UNION ALL SELECT uid, 'items', 'list' FROM ord)""",
)
def read_schemas_query(spark, sf):
    texts = extract_document(order_events(spark, sf), out="schema_json").select("uid", "schema_json")
    rows = read_schemas(texts).select("uid", F.explode_outer("schema").alias("p"))
    return rows.select("uid", F.col("p.propertyName").alias("name"), F.col("p.propertyType").alias("type"))


@query(
    "schema_fingerprint",
    _ORDER_DOCUMENT + "SELECT sha256(document) AS fingerprint, count(*) AS n FROM docs GROUP BY 1",
)
def schema_fingerprint_query(spark, sf):
    documents = extract_document(order_events(spark, sf))
    return documents.groupBy(schema_fingerprint(F.col("document")).alias("fingerprint")).agg(F.count("*").alias("n"))


_KEY = "0123456789abcdef"


@query(
    "protect_values",
    f"""WITH {EVENTS_SQL}
    SELECT uid, 'k' AS name, k AS opened FROM ev
    UNION ALL SELECT uid, 'label', concat('"', label, '"') FROM ev
    UNION ALL SELECT uid, 'flag', flag FROM ev WHERE flag IS NOT NULL
    UNION ALL SELECT uid, 'value', CASE WHEN value = floor(value) THEN cast(cast(value AS bigint) AS varchar)
                                        ELSE cast(value AS varchar) END FROM ev
    UNION ALL SELECT uid, 'code', code FROM ev WHERE n % 5 <> 4
    UNION ALL SELECT uid, 'tags', NULL FROM ev
    UNION ALL SELECT uid, 'code', NULL FROM ev WHERE n % 5 = 4
    UNION ALL SELECT uid, 'geo', CASE WHEN n % 6 = 0 THEN 'null' END FROM ev""",
)
def protect_values(spark, sf):
    """Sealed top-level values, opened again."""
    sealed = extract_document(rich_events(spark, sf), out="schema_json", seal=sealer(_KEY, "staging"))
    rows = read_schemas(sealed).select("uid", F.explode_outer("schema").alias("p"))
    opened = unseal(F.col("p.encryptedPropertyValue"), _KEY)
    return rows.select("uid", F.col("p.propertyName").alias("name"), opened.alias("opened"))
