"""Queries on specifications, lookup and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalog import query
from plumbline.catalog.inputs import (
    ALL_IDS,
    EVENTS_SQL,
    ORDERS_SQL,
    PART_SPECS_SQL,
    compact_sql,
    joined,
    order_events,
    part_specs,
    prop,
    result_sql,
    rich_events,
    same_spec,
    table,
    wire,
)
from plumbline.functions.documents import add_schema_document, open_levels
from plumbline.functions.patterns import compiled_only, translate
from plumbline.functions.planning import unnest
from plumbline.functions.values import each, value_text
from plumbline.operators.lookup import branch_epochs, lookup_spec, spec_asof, spec_keys_needed
from plumbline.operators.validate import add_results, failing_properties, property_results
from plumbline.sources.specs import all_event_ids, explode_constraints, load_specs, merge_constraints, read_specs

# ------------------------------------------------------------ specifications


@query(
    "read_specs",
    f"""WITH {PART_SPECS_SQL}
    SELECT event_name, NOT broken AS known, CASE WHEN NOT broken THEN concat('s', pk % 7) END AS schema_id,
           CASE WHEN NOT broken THEN CASE WHEN two THEN 2 ELSE 1 END END AS n_entries FROM ps""",
)
def read_specs_query(spark, sf):
    specs = read_specs(part_specs(spark, sf))
    return specs.select(
        "event_name",
        F.col("metadata").isNotNull().alias("known"),
        F.col("metadata.schemaId").alias("schema_id"),
        F.when(F.col("entries").isNotNull(), F.size("entries")).alias("n_entries"),
    )


_CONSTRAINTS = """
rows AS (
  SELECT event_name, 0 AS event_ord, 'size' AS path, false AS is_list, true AS required, 'minmax' AS kind, concat('1,', p_size) AS key, pid AS event_id FROM ok
  UNION ALL SELECT event_name, 0, 'size', false, true, 'minmax', concat(p_size, ','), concat(pid, '.v1') FROM ok
  UNION ALL SELECT event_name, 0, 'brand', false, true, 'pinned', p_brand, pid FROM ok
  UNION ALL SELECT event_name, 0, 'brand', false, true, 'pinned', p_brand, concat(pid, '.v2') FROM ok
  UNION ALL SELECT event_name, 0, 'type', false, false, 'allowed', concat('["', p_type, '","OTHER"]'), concat(pid, '.v1') FROM ok
  UNION ALL SELECT event_name, 0, 'dims.size', false, true, 'minmax', concat(',', p_size), concat(pid, '.v2') FROM ok
  UNION ALL SELECT event_name, 0, 'tags', true, false, 'pinned', 'x', concat(pid, '.v2') FROM ok
  UNION ALL SELECT event_name, 1, 'size', false, false, 'minmax', concat('1,', p_size), qid FROM ok WHERE two
  UNION ALL SELECT event_name, 1, 'extra', false, true, 'pinned', 'y', qid FROM ok WHERE two
  UNION ALL SELECT event_name, 1, 'extra', false, true, 'pinned', 'y', pid FROM ok WHERE two)
"""
_PART_ROWS = f"{PART_SPECS_SQL}, ok AS (SELECT * FROM ps WHERE NOT broken), {_CONSTRAINTS}"


@query("explode_constraints", f"WITH {_PART_ROWS} SELECT * FROM rows")
def explode_constraints_query(spark, sf):
    rows = explode_constraints(read_specs(part_specs(spark, sf)), ["event_name"])
    return rows.select(
        "event_name", "event_ord", F.array_join("path", ".").alias("path"), "is_list", "required", "kind", "key", "event_id"
    )


@query(
    "merge_constraints",
    f"""WITH {_PART_ROWS}
    SELECT r.event_name, r.path, r.kind, r.key, string_agg(DISTINCT r.event_id, ',' ORDER BY r.event_id) AS ids,
           any_value(f.required) AS required, any_value(r.path = 'tags' AND NOT ok.two) AS is_list
    FROM rows r JOIN (SELECT event_name, path, arg_min(required, event_ord) AS required FROM rows GROUP BY 1, 2) f
      ON f.event_name = r.event_name AND f.path = r.path JOIN ok ON ok.event_name = r.event_name
    GROUP BY 1, 2, 3, 4""",
)
def merge_constraints_query(spark, sf):
    merged = merge_constraints(read_specs(part_specs(spark, sf)))
    props = unnest(merged, ["event_name"], F.col("merged"), "p")
    rows = unnest(props, ["event_name", "p"], F.col("p.checks"), "c")
    return rows.select(
        "event_name",
        F.array_join("p.path", ".").alias("path"),
        "c.kind",
        "c.key",
        joined("c.event_ids").alias("ids"),
        "p.required",
        "p.is_list",
    )


@query(
    "all_event_ids",
    f"""WITH {PART_SPECS_SQL}
    SELECT event_name, CASE WHEN NOT broken THEN concat(pid, ',', pid, '.v1,', pid, '.v2', CASE WHEN two THEN concat(',', qid) ELSE '' END) END AS ids FROM ps""",
)
def all_event_ids_query(spark, sf):
    specs = read_specs(part_specs(spark, sf))
    return specs.select("event_name", F.array_join(F.expr(all_event_ids("entries")), ",").alias("ids"))


_PATTERN = """CASE p_partkey % 7
    WHEN 0 THEN concat('^', p_brand, '$') WHEN 1 THEN concat('(', p_type, '+)+') WHEN 2 THEN concat('[', p_brand)
    WHEN 3 THEN concat('^', p_brand, '[0-9]{2}$') WHEN 4 THEN concat('^[0-9]{5}(-', p_brand, '{4})?$')
    WHEN 5 THEN repeat('a*b', 26) ELSE concat(p_brand, '(x|y+)z?') END"""


@query(
    "gate_patterns",
    f"SELECT p_partkey, {_PATTERN} AS pattern, p_partkey % 7 IN (0, 3, 6) AS usable FROM part",
)
def gate_patterns(spark, sf):
    """Distinct patterns go through the gate once; the verdict is joined back."""
    patterns = table(spark, sf, "part").select("p_partkey", F.expr(_PATTERN).alias("pattern"))
    java = patterns.select("pattern").distinct().withColumn("_java", translate(F.array("pattern")))
    gated = java.select("pattern", F.get(F.expr(compiled_only("_java")), F.lit(0)).isNotNull().alias("usable"))
    return patterns.join(gated, "pattern")


# -------------------------------------------------------------------- lookup


@query(
    "lookup_spec",
    f"""WITH {EVENTS_SQL}
    SELECT uid, event_name NOT IN ('view', 'error') AS found, CASE WHEN event_name NOT IN ('view', 'error') THEN concat('schema-', event_name) END AS schema_id,
           CASE WHEN event_name NOT IN ('view', 'error') THEN 'e,v1,v2,v3' END AS ids FROM ev""",
)
def lookup_spec_query(spark, sf):
    """One name has no specification row, another a known-absent answer."""
    events = rich_events(spark, sf)
    document = F.lit(wire({}, schema_id="schema-NAME"))
    specs = (
        events.select("event_name").distinct().filter("event_name <> 'view'")
        .withColumn("spec_json", F.when(F.col("event_name") == "error", "{}").otherwise(F.replace(document, F.lit("NAME"), F.col("event_name"))))
    )
    found = lookup_spec(events, load_specs(specs, ["event_name"]))
    return found.select(
        "uid",
        F.col("plan").isNotNull().alias("found"),
        F.col("metadata.schemaId").alias("schema_id"),
        F.array_join("all_ids", ",").alias("ids"),
    )


@query(
    "lookup_spec_prod",
    "SELECT lpad(cast(event_id AS varchar), 12, '0') AS uid, event_type <> 'view' AS found, false AS found_in_prod FROM events",
)
def lookup_spec_prod(spark, sf):
    """The same lookup in both environments."""
    events = rich_events(spark, sf)
    specs = load_specs(same_spec(events.filter("event_name <> 'view'"), wire({})), ["event_name"])
    found = lookup_spec(events, specs).withColumn("found", F.col("plan").isNotNull()).drop("metadata", "all_ids", "plan")
    return lookup_spec(found, specs, env="prod").select("uid", "found", F.col("plan").isNotNull().alias("found_in_prod"))


_KEYS_SQL = f"""WITH {EVENTS_SQL}, loaded AS (SELECT client_id, event_name FROM ev GROUP BY 1, 2 HAVING min(n) % 2 = 0),
ready AS (SELECT client_id, concat(event_name, '-ready') AS event_name FROM ev)"""


def _loaded_keys(events, keys):
    """Keys that are loaded already: those whose first event has an even number."""
    return events.groupBy(*keys).agg(F.min("n").alias("first")).filter("first % 2 = 0").select(*keys)


@query(
    "spec_keys_needed",
    _KEYS_SQL + " SELECT client_id, event_name FROM ev EXCEPT SELECT * FROM loaded",
)
def spec_keys_needed_query(spark, sf):
    events, keys = rich_events(spark, sf), ["client_id", "event_name"]
    return spec_keys_needed(events, _loaded_keys(events, keys), keys)


@query(
    "schema_lookup_keys",
    _KEYS_SQL + " SELECT client_id, event_name FROM ev UNION SELECT * FROM ready EXCEPT SELECT * FROM loaded",
)
def schema_lookup_keys(spark, sf):
    events, keys = rich_events(spark, sf), ["client_id", "event_name"]
    ready = events.withColumn("event_name", F.concat("event_name", F.lit("-ready")))
    return spec_keys_needed(events, _loaded_keys(events, keys), keys, schemas=ready)


# a dense clock: one row every seven seconds, twenty clients; each row was fetched for up to 75 seconds before
_FETCH_SQL = """
dense AS (
  SELECT event_id AS n, concat('c', user_id % 20) AS client_id, event_type AS event_name,
         1704067200000 + event_id * 7000 + (event_id % 11) * 90 AS ms, CAST(props ->> '$.k' AS INT) AS k FROM events),
fetched AS (
  SELECT n, client_id, event_name, ms - n % 4 * 25000 AS ms, CASE WHEN n % 16 = 0 THEN NULL WHEN k % 10 < 7 THEN 'main' ELSE 'dev' END AS branch
  FROM dense),
cur AS (
  SELECT *, last_value(branch IGNORE NULLS) OVER (PARTITION BY client_id ORDER BY ms, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS current FROM fetched),
changes AS (SELECT *, coalesce(branch <> current, false) AS changed FROM cur),
epochs AS (
  SELECT *, max(CASE WHEN changed THEN ms END) OVER (PARTITION BY client_id ORDER BY ms, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch_ms,
         min(CASE WHEN changed THEN ms END) OVER (PARTITION BY client_id ORDER BY ms, n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS invalid_ms
  FROM changes)
"""


def _dense(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("n"),
        F.concat(F.lit("c"), (F.col("user_id") % 20).cast("string")).alias("client_id"),
        F.col("event_type").alias("event_name"),
        F.timestamp_millis(F.lit(1704067200000) + F.col("event_id") * 7000 + (F.col("event_id") % 11) * 90).alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    branch = F.when(F.col("n") % 16 == 0, None).when(F.col("k") % 10 < 7, "main").otherwise("dev")
    fetched = F.timestamp_millis(F.unix_millis("ts") - F.col("n") % 4 * 25000)
    fetches = rows.select("client_id", "event_name", fetched.alias("fetched_at"), F.col("n").alias("fetch_id"), branch.alias("branch_id"))
    return rows, fetches


@query(
    "branch_epochs",
    f"WITH {_FETCH_SQL} SELECT n AS fetch_id, changed AS branch_changed, epoch_ms, invalid_ms FROM epochs",
)
def branch_epochs_query(spark, sf):
    _, fetches = _dense(spark, sf)
    return branch_epochs(fetches, ["client_id"]).select("fetch_id", "branch_changed", "epoch_ms", "invalid_ms")


@query(
    "spec_asof",
    f"""WITH {_FETCH_SQL},
    j AS (SELECT d.n, d.ms, e.ms AS fms, e.branch, e.invalid_ms
          FROM dense d ASOF LEFT JOIN epochs e ON d.client_id = e.client_id AND d.event_name = e.event_name AND d.ms >= e.ms)
    SELECT n, CASE WHEN fms IS NULL OR ms - fms > 60000 OR coalesce(ms >= invalid_ms, false) THEN 'miss'
                   WHEN branch IS NULL THEN 'absent' ELSE 'hit' END AS state,
           CASE WHEN NOT (fms IS NULL OR ms - fms > 60000 OR coalesce(ms >= invalid_ms, false)) THEN branch END AS spec FROM j""",
)
def spec_asof_query(spark, sf):
    events, fetches = _dense(spark, sf)
    snapshots = branch_epochs(fetches, ["client_id"]).withColumn("spec", F.col("branch_id"))
    found = spec_asof(events, snapshots, ["client_id", "event_name"])
    return found.select("n", F.col("spec_state").alias("state"), "spec")


# ---------------------------------------------------------------- validation


def _validated(events, document, ids_keys=("event_name",)):
    specs = load_specs(same_spec(events, document), list(ids_keys))
    opened = lookup_spec(open_levels(events, "props"), specs)
    return add_results(opened, patterns=specs.patterns)


def _long(validated, *properties):
    rows = property_results(validated, ["uid"]).filter(F.col("property").isin(*properties))
    return rows.select("uid", "property", "child", joined("failed").alias("failed"), joined("passed").alias("passed"))


def _check(name: str, properties: dict, expected: dict[str, tuple[str, list]]) -> None:
    """Register a check of ``properties``; ``expected`` maps each to (row condition, violations)."""
    selects = [
        f"SELECT uid, '{p}' AS property, NULL::VARCHAR AS child, {result_sql(checks)} FROM ev WHERE {rows}"
        for p, (rows, checks) in expected.items()
    ]
    document = wire(properties)
    query(name, f"WITH {EVENTS_SQL} " + " UNION ALL ".join(selects))(
        lambda spark, sf: _long(_validated(rich_events(spark, sf), document), *expected)
    )


# text form of values in SQL
_VALUE_TEXT = "CASE WHEN value = floor(value) THEN cast(cast(value AS bigint) AS varchar) ELSE cast(value AS varchar) END"
_CODE_TEXT = "trim(code, '\"')"


@query(
    "value_text",
    f"""WITH {EVENTS_SQL}
    SELECT uid, 'k' AS name, k AS text FROM ev UNION ALL SELECT uid, 'value', {_VALUE_TEXT} FROM ev
    UNION ALL SELECT uid, 'label', label FROM ev UNION ALL SELECT uid, 'flag', flag FROM ev WHERE flag IS NOT NULL
    UNION ALL SELECT uid, 'code', {_CODE_TEXT} FROM ev UNION ALL SELECT uid, 'tags', replace(tags, ', ', ',') FROM ev
    UNION ALL SELECT uid, 'geo', geo FROM ev""",
)
def value_text_query(spark, sf):
    opened = open_levels(rich_events(spark, sf), "props", max_depth=1)
    rows = unnest(opened, ["uid"], F.expr(each("_level0", lambda m, _: f"named_struct('name', {m}.name, 'text', {value_text(m)})")), "m")
    return rows.select("uid", "m.name", "m.text")


_check(
    "check_pinned",
    {
        "k": prop(p={"5": ["e"], "7": ["v1"]}),
        "label": prop(p={"gold": ["e", "v1", "v2"]}),
        "code": prop(p={"true": ["v1"], '[5,"x"]': ["v2"], "null": ["v3"]}),
    },
    {
        "k": ("true", [("k <> '5'", ["e"]), ("k <> '7'", ["v1"])]),
        "label": ("true", [("label <> 'gold'", ["e", "v1", "v2"])]),
        "code": (
            "true",
            [(f"{_CODE_TEXT} <> 'true'", ["v1"]), (f"code <> '[5,\"x\"]'", ["v2"]), (f"{_CODE_TEXT} <> 'null'", ["v3"])],
        ),
    },
)

_check(
    "check_allowed",
    {
        "label": prop(v={'["gold","silver-5"]': ["e"], "[]": ["v1"], "oops": ["v2"]}),
        "code": prop(v={'["true","null",5]': ["v3"], '["5","6"]': ["e", "v1"]}),
        "k": prop(v={"[5,6]": ["e"], '["5","6","7"]': ["v1"]}),
    },
    {
        "label": ("true", [("label NOT IN ('gold', 'silver-5')", ["e"]), ("true", ["v1"])]),
        "code": (
            "true",
            [(f"{_CODE_TEXT} NOT IN ('true', 'null')", ["v3"]), (f"{_CODE_TEXT} NOT IN ('5', '6')", ["e", "v1"])],
        ),
        "k": ("true", [("true", ["e"]), ("k NOT IN ('5', '6', '7')", ["v1"])]),
    },
)

_check(
    "check_regex",
    {
        "label": prop(rx={"^silver-[0-9]+$": ["e"], "^B[1-9]": ["v1", "v2"], "(a+)+$": ["v3"], "[oops": ["v3"]}),
        "k": prop(rx={"^5": ["e"], "(a+)+$": ["v3"]}),
        "code": prop(rx={"[13579]$": ["v1"]}),
    },
    {
        "label": (
            "true",
            [
                ("NOT regexp_matches(label, '^silver-[0-9]+$')", ["e"]),
                ("NOT regexp_matches(label, '^B[1-9]')", ["v1", "v2"]),
            ],
        ),
        "k": ("true", [("true", ["e", "v3"])]),
        "code": ("true", [("n % 5 <> 0 OR NOT regexp_matches(code, '[13579]\"$')", ["v1"])]),
    },
)

_check(
    "check_min_max",
    {
        "value": prop(minmax={"10,50": ["e"], "20.5,": ["v1"], ",30": ["v2"], "x,5": ["v3"]}),
        "k": prop(minmax={"5abc,60": ["e"], "1e1,9": ["v1"], ",": ["v2"]}),
        "label": prop(minmax={"0,100": ["e"], "x,": ["v1"]}),
    },
    {
        "value": (
            "true",
            [("value < 10 OR value > 50", ["e"]), ("value < 20.5", ["v1"]), ("value > 30", ["v2"])],
        ),
        "k": ("true", [("CAST(k AS INT) < 5 OR CAST(k AS INT) > 60", ["e"]), ("true", ["v1"])]),
        "label": ("true", [("true", ["e", "v1"])]),
    },
)

_check(
    "skip_optional_null",
    {"flag": prop(required=False, p={"true": ["e"]}), "code": prop(required=True, v={'["true"]': ["v1"]})},
    {
        "flag": ("flag IS NOT NULL", [("flag = 'false'", ["e"])]),
        "code": ("true", [(f"{_CODE_TEXT} <> 'true'", ["v1"])]),
    },
)

_check(
    "check_primitive",
    {
        "label": prop(p={"gold": ["e"]}, v={'["gold",""]': ["e", "v1"]}, rx={"^g": ["v2"]}),
        "value": prop(p={"25.5": ["v3"]}, minmax={"0,40": ["e", "v1"]}),
    },
    {
        "label": (
            "true",
            [("label <> 'gold'", ["e"]), ("label NOT IN ('gold', '')", ["e", "v1"]), ("label NOT LIKE 'g%'", ["v2"])],
        ),
        "value": ("true", [("value <> 25.5", ["v3"]), ("value > 40", ["e", "v1"])]),
    },
)

_check(
    "check_list",
    {
        "tags": prop(is_list=True, v={'["a","gold","true","b"]': ["e"]}, minmax={"0,50": ["v1"]}, p={"null": ["v2"]}),
        "label": prop(is_list=True, p={"gold": ["e"]}),
    },
    {
        "tags": ("true", [("n % 3 <> 0", ["e"]), ("n % 3 <> 0", ["v1"]), ("n % 3 <> 0", ["v2"])]),
        "label": ("true", []),
    },
)

_OBJECT_SPEC = {
    "geo": prop(
        children={
            "city": prop(required=False, p={"gold": ["e", "v1"]}),
            "zip": prop(minmax={"1000,150000": ["v2"]}),
            "lat": prop(p={"1": ["v3"]}),
            "in": prop(children={"x": prop(p={"never": ["e"]})}),
        }
    )
}
_NO_GEO = "n % 6 = 0"
_ZIP = "CAST(concat('1', k, '000') AS BIGINT)"


def _geo_rows(child: str, checks: list, rows: str = "true") -> str:
    return (
        f"SELECT * FROM (SELECT uid, 'geo' AS property, '{child}' AS child, {result_sql(checks)} FROM ev WHERE {rows}) "
        "WHERE failed IS NOT NULL OR passed IS NOT NULL"
    )


_OBJECT_SQL = " UNION ALL ".join(
    [
        "SELECT uid, 'geo' AS property, NULL::VARCHAR AS child, NULL::VARCHAR AS failed, NULL::VARCHAR AS passed FROM ev",
        _geo_rows("city", [("label <> 'gold'", ["e", "v1"])], f"NOT ({_NO_GEO}) AND n % 4 <> 3"),
        _geo_rows("zip", [(f"{_NO_GEO} OR {_ZIP} < 1000 OR {_ZIP} > 150000", ["v2"])]),
        _geo_rows("lat", [("true", ["v3"])]),
    ]
)


@query("check_object", f"WITH {EVENTS_SQL} {_OBJECT_SQL}")
def check_object(spark, sf):
    """Declared children of an object; a null parent fails its required children."""
    return _long(_validated(rich_events(spark, sf), wire(_OBJECT_SPEC)), "geo")


_DEPTH_SQL = " UNION ALL ".join(
    [
        "SELECT uid, 'geo' AS property, NULL::VARCHAR AS child, NULL::VARCHAR AS failed, NULL::VARCHAR AS passed FROM ev",
        _geo_rows("zip", [(f"{_NO_GEO} OR {_ZIP} > 150000", ["v2"]), (f"{_NO_GEO} OR {_ZIP} > 120000", ["v1", "v3"])]),
    ]
)


@query("depth_limit", f"WITH {EVENTS_SQL} {_DEPTH_SQL}")
def depth_limit(spark, sf):
    """Children are validated; grandchildren are declared, with values that never occur, but not validated."""
    inner = prop(children={"x": prop(p={"never": ["e"]})})
    zip_code = prop(minmax={"1000,150000": ["v2"], "1000,120000": ["v1", "v3"]})
    return _long(_validated(rich_events(spark, sf), wire({"geo": prop(children={"in": inner, "zip": zip_code})})), "geo")


_ITEMS_SPEC = {
    "items": prop(
        is_list=True,
        children={
            "qty": prop(minmax={"1,45": ["e"], "2,": ["v1", "v2"]}),
            "flag": prop(v={'["A","N","R"]': ["v3"], '["A","N"]': ["v1"]}),
            "price": prop(minmax={"1000,": ["e", "v1", "v2"]}),
            "gift": prop(p={"yes": ["v1", "v2", "v3"]}),
            "note": prop(required=False, p={"yes": ["e"]}),
        },
    )
}


def _item_rows(child: str, checks: list) -> str:
    return (
        f"SELECT * FROM (SELECT concat('o', l_orderkey) AS uid, 'items' AS property, '{child}' AS child, {result_sql(checks)} "
        "FROM bad) WHERE failed IS NOT NULL OR passed IS NOT NULL"
    )


@query(
    "check_list_of_objects",
    f"""WITH {ORDERS_SQL},
    bad AS (SELECT l_orderkey, bool_or(l_quantity > 45 OR l_quantity < 1) AS q1, bool_or(l_quantity < 2) AS q2,
                   bool_or(l_returnflag NOT IN ('A', 'N', 'R')) AS f1, bool_or(l_returnflag NOT IN ('A', 'N')) AS f2,
                   bool_or(l_extendedprice < 1000) AS p1 FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1)
    SELECT uid, 'items' AS property, NULL::VARCHAR AS child, NULL::VARCHAR AS failed, NULL::VARCHAR AS passed FROM ord
    UNION ALL {_item_rows('qty', [('q1', ['e']), ('q2', ['v1', 'v2'])])}
    UNION ALL {_item_rows('flag', [('f1', ['v3']), ('f2', ['v1'])])}
    UNION ALL {_item_rows('price', [('p1', ['e', 'v1', 'v2'])])}
    UNION ALL {_item_rows('gift', [('true', ['v1', 'v2', 'v3'])])}""",
)
def check_list_of_objects(spark, sf):
    return _long(_validated(order_events(spark, sf), wire(_ITEMS_SPEC)), "items")


@query(
    "compact_result",
    f"""WITH {EVENTS_SQL} SELECT uid, 'k' AS property, NULL::VARCHAR AS child,
    {result_sql([("CAST(k AS INT) < 20", ["e"]), ("CAST(k AS INT) < 40", ["v1"]), ("CAST(k AS INT) < 60", ["v2"]),
                 ("CAST(k AS INT) < 80", ["v3"])], ids=["e", "v1", "v2", "v3", "e"])} FROM ev""",
)
def compact_result(spark, sf):
    """Two name-mapped entries share an id, so the full list holds it twice."""
    spec = {"k": prop(minmax={"20,": ["e"], "40,": ["v1"], "60,": ["v2"], "80,": ["v3"]})}
    document = wire(spec).replace("}], \"metadata\"", '}, {"b":"main","id":"e","vids":[],"p":{}}], "metadata"')
    return _long(_validated(rich_events(spark, sf), document), "k")


# the flagship: every kind of constraint at once, some names without a specification
_FLAGSHIP = {
    "k": prop(minmax={"10,90": ["e", "v1"], "0,": ["v2"]}),
    "value": prop(minmax={",60": ["v3"]}),
    "label": prop(v={'["gold","B5"]': ["e"]}, rx={"^[a-zB]": ["v1"]}),
    "flag": prop(required=False, p={"true": ["v2"]}),
    **_OBJECT_SPEC,
    "tags": prop(is_list=True, required=False, v={'["a","b","gold","true"]': ["v3"]}),
}
_SPEC_NAMES = "('click', 'signup', 'purchase')"
_FLAGSHIP_ROWS = {
    "k": ("true", [("CAST(k AS INT) < 10 OR CAST(k AS INT) > 90", ["e", "v1"])]),
    "value": ("true", [("value > 60", ["v3"])]),
    "label": ("true", [("label NOT IN ('gold', 'B5')", ["e"]), ("label = ''", ["v1"])]),
    "flag": ("flag IS NOT NULL", [("flag = 'false'", ["v2"])]),
    "code": ("true", []),
    "tags": ("true", [("n % 3 <> 0", ["v3"])]),
}


def _flagship(spark, sf):
    events = rich_events(spark, sf)
    specs = same_spec(events, wire(_FLAGSHIP)).filter(f"event_name IN {_SPEC_NAMES}")
    loaded = load_specs(specs, ["event_name"])
    return add_results(lookup_spec(open_levels(events, "props"), loaded), patterns=loaded.patterns)


@query(
    "validate_events",
    f"WITH {EVENTS_SQL}, all_rows AS ("
    + " UNION ALL ".join(
        f"SELECT uid, '{p}' AS property, NULL::VARCHAR AS child, {result_sql(checks)} FROM ev WHERE {rows}"
        for p, (rows, checks) in _FLAGSHIP_ROWS.items()
    )
    + f" UNION ALL {_OBJECT_SQL}) SELECT a.* FROM all_rows a JOIN ev USING (uid) WHERE event_name IN {_SPEC_NAMES}",
)
def validate_events(spark, sf):
    rows = property_results(_flagship(spark, sf), ["uid"])
    return rows.select("uid", "property", "child", joined("failed").alias("failed"), joined("passed").alias("passed"))


@query(
    "failing_properties",
    f"WITH {EVENTS_SQL}, all_rows AS ("
    + " UNION ALL ".join(
        f"SELECT uid, '{p}' AS property, {result_sql(checks)} FROM ev WHERE {rows}"
        for p, (rows, checks) in _FLAGSHIP_ROWS.items()
    )
    + f") SELECT uid, property, failed FROM all_rows JOIN ev USING (uid) WHERE event_name IN {_SPEC_NAMES} AND failed IS NOT NULL",
)
def failing_properties_query(spark, sf):
    rows = failing_properties(_flagship(spark, sf), ["uid"])
    return rows.select("uid", "property", joined("failed").alias("failed"))


@query(
    "merge_results",
    """WITH e AS (SELECT event_id, event_type, CAST(props ->> '$.k' AS INT) AS k FROM events)
    SELECT event_id, concat('[{"propertyName":"k","propertyType":"int"',
      CASE WHEN event_type NOT IN ('click', 'view') THEN ''
           WHEN k > 50 AND k > 80 THEN ',"passedEventIds":["v3"]'
           WHEN k > 50 THEN ',"failedEventIds":["v1","e"]'
           WHEN k < 10 THEN ',"failedEventIds":["v2"]' ELSE '' END, '}]') AS document FROM e""",
)
def merge_results(spark, sf):
    """Documents with the validation ids merged in, in checking order."""
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("event_name"), "props")
    spec = {"k": prop(minmax={"0,50": ["v1", "e"], "10,80": ["v2"]})}
    specs = same_spec(events, wire(spec)).filter("event_name IN ('click', 'view')")
    loaded = load_specs(specs, ["event_name"])
    checked = add_results(lookup_spec(open_levels(events, "props"), loaded), patterns=loaded.patterns)
    return add_schema_document(checked, "document", results="results").select("event_id", "document")


_PART_IDS = "CASE WHEN two THEN [pid, concat(pid, '.v1'), concat(pid, '.v2'), qid] ELSE [pid, concat(pid, '.v1'), concat(pid, '.v2')] END"


def _part_case(*pairs: tuple[str, str]) -> str:
    return "list_distinct(flatten([" + ", ".join(f"CASE WHEN {c} THEN {ids} ELSE []::VARCHAR[] END" for c, ids in pairs) + "]))"


@query(
    "validate_part_plan",
    f"""WITH {PART_SPECS_SQL},
    li AS (SELECT concat(l_orderkey, '|', l_linenumber, '|', l_partkey, '|', l_suppkey) AS line, l_quantity AS q, l_linenumber * 5 AS d,
                  concat('Brand#', l_suppkey % 50 + 1) AS b, ps.* FROM lineitem JOIN ps ON pk = l_partkey WHERE NOT broken),
    f AS (SELECT *, {_PART_IDS} AS ids FROM li),
    res AS (
      SELECT line, 'size' AS property, NULL::VARCHAR AS child, {_part_case(("q < 1 OR q > p_size", "CASE WHEN two THEN [pid, qid] ELSE [pid] END"), ("q < p_size", "[concat(pid, '.v1')]"))} AS bad, ids FROM f
      UNION ALL SELECT line, 'brand', NULL, {_part_case(("b <> p_brand", "[pid, concat(pid, '.v2')]"))}, ids FROM f
      UNION ALL SELECT line, 'dims', NULL, []::VARCHAR[], ids FROM f
      UNION ALL SELECT line, 'dims', 'size', {_part_case(("d > p_size", "[concat(pid, '.v2')]"))}, ids FROM f),
    out AS (SELECT line, property, child, {compact_sql("bad", "ids")} FROM res)
    SELECT line, property, child, failed, passed, count(*) AS n FROM out
    WHERE child IS NULL OR failed IS NOT NULL OR passed IS NOT NULL GROUP BY ALL""",
)
def validate_part_plan(spark, sf):
    """One specification per part: the lookup side grows with the data."""
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    props = F.concat(
        F.lit('{"size":'), F.col("l_quantity").cast("string"),
        F.lit(',"brand":"Brand#'), (F.col("l_suppkey") % 50 + 1).cast("string"),
        F.lit('","dims":{"size":'), (F.col("l_linenumber") * 5).cast("string"), F.lit("}}"),
    )
    events = table(spark, sf, "lineitem").select(
        line.alias("line"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("event_name"), props.alias("props")
    )
    specs = load_specs(part_specs(spark, sf), ["event_name"])
    checked = add_results(lookup_spec(open_levels(events, "props"), specs), patterns=specs.patterns)
    rows = property_results(checked, ["line"])
    keys = ["line", "property", "child", "failed", "passed"]
    rows = rows.select("line", "property", "child", joined("failed").alias("failed"), joined("passed").alias("passed"))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))
