"""Inputs the queries share: event streams and specifications derived from the test tables.

Each Spark derivation has a twin in SQL, kept next to it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import configure
from plumbline.sources.commit import stored_bytes


#: bytes and rows of a stored table that one task reads, at most
_TASK_BYTES, _TASK_ROWS, _MOST_TASKS = 2 << 20, 100_000, 10_000


def tasks_for(spark: SparkSession, path: str, each: int = _TASK_BYTES, rows: int = _TASK_ROWS) -> int:
    """How many tasks share the work on a stored table: one for each core, and more as it grows.

    Stored bytes alone are no measure: columns of few values shrink so much that a task's share of
    the bytes holds several times the rows.  Rows are counted from the footers of the files.
    """
    wanted = max(-(-stored_bytes(spark, path) // each), -(-spark.read.parquet(path).count() // rows))
    return max(spark.sparkContext.defaultParallelism, min(_MOST_TASKS, wanted))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, spread over the cores and over more tasks as it grows.

    Splits of a file are no measure: a row group goes to one of them whole, so some are empty
    and others hold a million rows, and their number stays that of the cores while the table grows.
    """
    configure(spark)
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.parquet(path).repartition(tasks_for(spark, path))


def joined(ids: str):
    """Sorted ids as text, for comparison."""
    return F.array_join(F.array_sort(ids), ",")


# ---------------------------------------------------------------- rich events

_EVENT_COLUMNS = """
    lpad(cast(event_id as string), 12, '0') AS uid,
    event_id AS n,
    concat('u', cast(user_id as string)) AS client_id,
    event_type AS event_name,
    ts,
    CASE WHEN event_id % 2 = 0 THEN 'manual' ELSE 'codegen' END AS source,
    CASE WHEN event_id % 2 = 1 THEN concat('evt-', event_type) END AS event_id,
    CASE WHEN event_id % 2 = 1 THEN concat('hash-', cast(event_id % 97 as string)) END AS event_hash,
    k,
    value,
    CASE event_id % 4 WHEN 0 THEN 'gold' WHEN 1 THEN concat('silver-', k) WHEN 2 THEN concat('B', k) ELSE '' END AS label,
    CASE WHEN event_id % 10 = 0 THEN 'null' WHEN event_id % 7 = 0 THEN NULL
         WHEN cast(k as int) % 2 = 0 THEN 'true' ELSE 'false' END AS flag,
    CASE event_id % 5 WHEN 0 THEN concat('"', k, '"') WHEN 1 THEN k WHEN 2 THEN 'true' WHEN 3 THEN 'null'
         ELSE concat('[', k, ',"x"]') END AS code,
    CASE event_id % 3 WHEN 0 THEN '[]' WHEN 1 THEN concat('["a", ', k, ', ', k, '.5, true, "b"]')
         ELSE concat('[', k, ', null, "gold"]') END AS tags
"""

# twin of rich_events; ``k`` is text on both sides
EVENTS_SQL = f"""
src AS (SELECT event_id, ts, user_id, event_type, value, props ->> '$.k' AS k FROM events),
cols AS (SELECT {_EVENT_COLUMNS.replace("string", "varchar")}, epoch_ms(ts) AS ms FROM src),
ev AS (
  SELECT *,
    CASE WHEN n % 6 = 0 THEN 'null'
         ELSE concat('{{"city":', CASE WHEN n % 4 = 3 THEN 'null' ELSE concat('"', label, '"') END,
                     ',"zip":1', k, '000,"in":{{"x":', k, '}}}}') END AS geo
  FROM cols)
"""


def rich_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with property objects of every value type, nested ones included."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
    )
    rows = rows.selectExpr(*_split(_EVENT_COLUMNS))
    geo = F.expr(
        """CASE WHEN n % 6 = 0 THEN 'null'
                ELSE concat('{"city":', CASE WHEN n % 4 = 3 THEN 'null' ELSE concat('"', label, '"') END,
                            ',"zip":1', k, '000,"in":{"x":', k, '}}') END"""
    )
    member = lambda name, text: F.concat(F.lit(f'"{name}": '), text)
    props = F.concat(
        F.lit("{"),
        F.concat_ws(
            ", ",
            member("k", F.col("k")),
            member("value", F.col("value").cast("string")),
            member("label", F.concat(F.lit('"'), "label", F.lit('"'))),
            member("flag", F.col("flag")),
            member("code", F.col("code")),
            member("tags", F.col("tags")),
            member("geo", F.col("geo")),
        ),
        F.lit("}"),
    )
    rows = rows.withColumn("geo", geo).withColumn("props", props)
    return rows.select("uid", "n", "client_id", "event_name", "ts", "source", "event_id", "event_hash", "props")


def _split(columns: str) -> list[str]:
    """Split a select list at its top-level commas."""
    parts, depth, start, quoted = [], 0, 0, False
    for i, c in enumerate(columns):
        quoted ^= c == "'"
        if not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 0:
                parts.append(columns[start:i].strip())
                start = i + 1
    return parts + [columns[start:].strip()]


# ------------------------------------------------------------------- orders

_ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

# twin of order_events
ORDERS_SQL = """
items AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS pos
  FROM lineitem),
ord AS (
  SELECT o_orderkey, concat('o', o_orderkey) AS uid, o_orderstatus, o_orderpriority, o_totalprice, o_custkey
  FROM orders)
"""


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One "Order Completed" event per order with its lines, if any, as a list of objects."""
    item = F.concat(
        F.lit('{"part":'),
        F.col("l_partkey").cast("string"),
        F.lit(',"qty":'),
        F.col("l_quantity").cast("string"),
        F.lit(',"price":'),
        F.col("l_extendedprice").cast("string"),
        F.lit(',"flag":"'),
        F.col("l_returnflag"),
        F.lit('"}'),
    )
    # a number that stays: by their bytes, tasks would be put together to hardly more than there are cores,
    # and stored bytes, from which the planner guesses, would have it send the lines of all orders to every task
    tasks = tasks_for(spark, f"{sf_dir}/lineitem.parquet", 4 * _TASK_BYTES, 2 * _TASK_ROWS)
    lines = (
        table(spark, sf_dir, "lineitem")
        .repartition(tasks, "l_orderkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.array_sort(F.collect_list(F.struct(*_ITEM_ORDER, item.alias("item")))).alias("lines"))
    )
    props = F.concat(
        F.lit('{"status":"'),
        F.col("o_orderstatus"),
        F.lit('","total":'),
        F.col("o_totalprice").cast("string"),
        F.lit(',"customer":{"id":'),
        F.col("o_custkey").cast("string"),
        F.lit(',"priority":"'),
        F.col("o_orderpriority"),
        F.lit('"},"items":['),
        F.coalesce(F.array_join(F.col("lines.item"), ","), F.lit("")),
        F.lit("]}"),
    )
    return (
        table(spark, sf_dir, "orders")
        .repartition(tasks, "o_orderkey")
        .join(lines.hint("merge"), "o_orderkey", "left")
        .select(
            F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("uid"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("client_id"),
            F.lit("Order Completed").alias("event_name"),
            F.col("o_orderdate").cast("timestamp").alias("ts"),
            props.alias("props"),
        )
    )


# ------------------------------------------------------------- specifications

ALL_IDS = ["e", "v1", "v2", "v3"]


def wire(properties: dict, ids: list[str] = ALL_IDS, schema_id: str = "schema-1") -> str:
    """Wire document with one entry."""
    entry = {"b": "main", "id": ids[0], "vids": ids[1:], "p": properties}
    return json.dumps({"events": [entry], "metadata": {"schemaId": schema_id, "branchId": "main", "latestActionId": "a1"}})


def prop(required: bool = True, is_list: bool = False, **constraints) -> dict:
    """Wire form of a property; keywords are wire names (p, v, rx, minmax, children)."""
    return {"t": "any", "r": required, **({"l": True} if is_list else {}), **constraints}


def same_spec(events: DataFrame, document: str) -> DataFrame:
    """The same wire document for every event name in the data."""
    return events.select("event_name").distinct().withColumn("spec_json", F.lit(document))


def result_sql(checks: list[tuple[str, list[str]]], ids: list[str] = ALL_IDS) -> str:
    """SQL for the ``failed`` and ``passed`` columns, from (violation, ids) pairs."""
    literal = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]::VARCHAR[]"
    parts = [f"CASE WHEN {violation} THEN {literal(of)} ELSE []::VARCHAR[] END" for violation, of in checks]
    failed = "list_distinct(flatten([" + ", ".join(parts or ["[]::VARCHAR[]"]) + "]))"
    return compact_sql(failed, literal(ids))


def compact_sql(failed: str, ids: str) -> str:
    """SQL for the shorter of the two id lists, as sorted text."""
    passed = f"list_filter({ids}, lambda i: NOT list_contains({failed}, i))"
    prefers = f"(len({passed}) < len({failed}) AND len({passed}) > 0)"
    text = lambda ids_sql: f"array_to_string(list_sort({ids_sql}), ',')"
    return (
        f"CASE WHEN len({failed}) > 0 AND NOT {prefers} THEN {text(failed)} END AS failed, "
        f"CASE WHEN {prefers} THEN {text(passed)} END AS passed"
    )


# part catalogue as a large specification table: one document per part

PART_SPECS_SQL = """
ps AS (
  SELECT p_partkey AS pk, concat('part ', p_partkey) AS event_name, p_size, p_brand, p_type,
         p_partkey % 3 = 0 AS two, p_partkey % 10 = 9 AS broken,
         concat('p', p_partkey) AS pid, concat('q', p_partkey) AS qid
  FROM part)
"""


def part_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire documents from ``part``: every third has two entries, every tenth a bad shape."""
    pid, qid = "concat('p', p_partkey)", "concat('q', p_partkey)"
    ids = lambda *names: "concat('[', concat_ws(',', " + ", ".join(f"concat('\"', {n}, '\"')" for n in names) + "), ']')"
    v1, v2 = f"concat({pid}, '.v1')", f"concat({pid}, '.v2')"
    first = f"""concat('{{"b":"main","id":"', {pid}, '","vids":', {ids(v1, v2)}, ',"p":{{',
        '"size":{{"t":"int","r":true,"minmax":{{"1,', p_size, '":', {ids(pid)}, ',"', p_size, ',":', {ids(v1)}, '}}}},',
        '"brand":{{"t":"string","r":true,"p":{{"', p_brand, '":', {ids(pid, v2)}, '}}}},',
        '"type":{{"t":"string","r":false,"v":{{"[\\\\"', p_type, '\\\\",\\\\"OTHER\\\\"]":', {ids(v1)}, '}}}},',
        '"dims":{{"t":"object","r":true,"children":{{"size":{{"t":"int","r":true,"minmax":{{",', p_size, '":', {ids(v2)}, '}}}}}}}},',
        '"tags":{{"t":"string","r":false,"l":true,"p":{{"x":', {ids(v2)}, '}}}}}}}}')"""
    second = f"""concat(',{{"b":"main","id":"', {qid}, '","vids":[],"p":{{',
        '"size":{{"t":"int","r":false,"minmax":{{"1,', p_size, '":', {ids(qid)}, '}}}},',
        '"extra":{{"t":"string","r":true,"p":{{"y":', {ids(qid, pid)}, '}}}}}}}}')"""
    document = f"""concat('{{"events":[', {first}, if(p_partkey % 3 = 0, {second}, ''),
        '],"metadata":{{"schemaId":', if(p_partkey % 10 = 9, '1', concat('"s', p_partkey % 7, '"')),
        ',"branchId":"main","latestActionId":"a"}}}}')"""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("event_name"), F.expr(document).alias("spec_json")
    )
