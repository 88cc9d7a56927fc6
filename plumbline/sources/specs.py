"""Tracking-plan specifications: wire text to constraint rows and a compiled lookup table.

A specification is one JSON document per lookup key, so parsing, flattening and
merging are all row-local array expressions: the table is never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.deep import declared_below
from plumbline.functions.patterns import compiled_only, translate
from plumbline.functions.planning import BROADCAST_BYTES, pin, settle, unnest
from plumbline.functions.values import each, keep, let, some

# fixed values: constraint kinds in checking order, with their wire names
KINDS = (("pinned", "p"), ("allowed", "v"), ("regex", "rx"), ("minmax", "minmax"))

_IDS = "map<string,array<string>>"
_PROPERTY = f"struct<t:string,r:boolean,l:boolean,p:{_IDS},v:{_IDS},rx:{_IDS},minmax:{_IDS},children:string>"
_WIRE = (
    "struct<events:array<struct<b:string,id:string,vids:array<string>,p:string>>,"
    "metadata:struct<schemaId:string,branchId:string,latestActionId:string,sourceId:string>>"
)
# fixed value: a key JavaScript lists first
_INDEX_KEY = "r'^(0|[1-9][0-9]{0,9})$'"

LITERAL_PATTERNS = 64


def read_specs(df: DataFrame, text: str = "spec_json") -> DataFrame:
    """Parse wire documents (A3): adds ``entries`` and ``metadata``, NULL when the shape is wrong."""
    document = F.try_parse_json(text)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    shaped = kind("$.events").startswith("ARRAY")
    for name in ("schemaId", "branchId", "latestActionId"):
        shaped = shaped & (kind(f"$.metadata.{name}") == "STRING")
    wire = F.when(F.coalesce(shaped, F.lit(False)), F.from_json(text, _WIRE))
    return (
        df.withColumn("_wire", wire)
        .withColumn("entries", F.col("_wire.events"))
        .withColumn("metadata", F.col("_wire.metadata"))
        .drop("_wire")
    )


def all_event_ids(entries: str) -> str:
    """Base id and variant ids of every entry, repeats kept (C14), as SQL."""
    ids = each(entries, lambda e, _: f"concat(array({e}.id), coalesce({e}.vids, CAST(array() AS array<string>)))")
    return f"flatten({ids})"


_CHECK = "struct<rank:int,event_ord:int,key_ord:bigint,kind:string,key:string,event_ids:array<string>>"


def _checks(p: str, event_ord: str) -> str:
    def rows(kind: str, wire: str, rank: int) -> str:
        # index-like keys come first, as in a JavaScript object
        order = lambda e, i: (
            f"CASE WHEN {e}.key RLIKE {_INDEX_KEY} THEN CAST(try_to_number({e}.key, '9999999999') AS bigint) - {1 << 34} "
            f"ELSE CAST({i} AS bigint) END"
        )
        checks = each(
            f"map_entries({p}.{wire})",
            lambda e, i: f"named_struct('rank', {rank}, 'event_ord', {event_ord}, 'key_ord', {order(e, i)}, "
            f"'kind', '{kind}', 'key', {e}.key, 'event_ids', {e}.value)",
        )
        return f"coalesce({checks}, CAST(array() AS array<{_CHECK}>))"

    return f"concat({', '.join(rows(kind, wire, rank) for rank, (kind, wire) in enumerate(KINDS))})"


def _properties(json_map: str, path: str, event_ord: str, base_id: str) -> str:
    return each(
        f"map_entries(from_json({json_map}, 'map<string,{_PROPERTY}>'))",
        lambda e, i: f"""named_struct('event_ord', {event_ord}, 'base_event_id', {base_id},
            'path', concat({path}, array({e}.key)), 'prop_ord', {i}, 'type', {e}.value.t,
            'required', coalesce({e}.value.r, false), 'is_list', coalesce({e}.value.l, false),
            'has_children', {e}.value.children IS NOT NULL, 'checks', {_checks(e + '.value', event_ord)},
            'children', {e}.value.children)""",
    )


_DECLARED = (
    "array<struct<event_ord:int,base_event_id:string,path:array<string>,prop_ord:int,type:string,"
    f"required:boolean,is_list:boolean,has_children:boolean,checks:array<{_CHECK}>,children:string>>"
)


def flatten_properties(specs: DataFrame, levels: int = 8, below: bool = True) -> DataFrame:
    """Add ``properties``: one struct per declared property of every entry, at every level.

    ``levels`` are opened by column expressions; children below them are followed by an Arrow
    helper, which gets NULL for every document without any.  ``below=False`` is for callers
    that use the opened levels only.
    """
    root = "CAST(array() AS array<string>)"
    top = each("entries", lambda e, i: f"coalesce({_properties(e + '.p', root, i, e + '.id')}, array())")
    df = specs.withColumn("_p0", F.expr(f"flatten({top})"))
    for depth in range(1, levels):
        below = each(
            keep(f"_p{depth - 1}", lambda p, _: f"{p}.has_children"),
            lambda p, _: f"coalesce({_properties(p + '.children', p + '.path', p + '.event_ord', p + '.base_event_id')}, array())",
        )
        df = df.withColumn(f"_p{depth}", F.expr(f"flatten({below})"))
    names = [f"_p{d}" for d in range(levels)]
    if below:
        parents = each(
            keep(names[-1], lambda p, _: f"{p}.has_children"),
            lambda p, _: f"named_struct('path', {p}.path, 'event_ord', {p}.event_ord, 'base_event_id', {p}.base_event_id, 'children', {p}.children)",
        )
        df = pin(df, "_parents", F.expr(f"CASE WHEN {some(names[-1], lambda p: f'{p}.has_children')} THEN to_json({parents}) END"))
        df = pin(df, "_below", F.from_json(declared_below(F.col("_parents")), _DECLARED)).drop("_parents")
        names.append("_below")
    every = F.concat(*[F.coalesce(F.col(n).cast(_DECLARED), F.array().cast(_DECLARED)) for n in names])
    # a document of the wrong shape declares nothing that is known
    return df.withColumn("properties", F.when(F.col("_p0").isNotNull(), every)).drop(*names)


def explode_constraints(specs: DataFrame, keys: list[str], levels: int = 8) -> DataFrame:
    """One row per key, property path, constraint and event id (A4)."""
    return (
        unnest(flatten_properties(specs, levels), keys, F.col("properties"), "p")
        .select(
            *keys,
            "p.event_ord",
            "p.base_event_id",
            "p.path",
            (F.size("p.path") - 1).alias("depth"),
            "p.is_list",
            "p.required",
            F.explode_outer("p.checks").alias("c"),
        )
        .filter(F.col("c.kind").isNotNull())
        .select("*", "c.kind", "c.key", F.explode_outer("c.event_ids").alias("event_id"))
        .filter(F.col("event_id").isNotNull())
        .drop("c")
    )


def _merge_checks(rows: str) -> str:
    """One check per (kind, key) with the union of its ids, in first-seen order."""
    same = lambda a, b: f"({a}.kind = {b}.kind AND {a}.key = {b}.key)"

    def merge(ordered: str) -> str:
        names = each(ordered, lambda c, _: f"struct({c}.kind, {c}.key)")
        first = let(
            names,
            lambda n: keep(ordered, lambda c, i: f"array_position({n}, struct({c}.kind, {c}.key)) = {i} + 1"),
        )
        union = lambda c: let(keep(ordered, lambda o, _: same(o, c)), lambda k: f"array_distinct(flatten({k}.event_ids))")
        return each(first, lambda c, _: f"named_struct('kind', {c}.kind, 'key', {c}.key, 'event_ids', {union(c)})")

    return let(f"array_sort({rows})", merge)


def merge_constraints(specs: DataFrame, keep_is_list: bool = False) -> DataFrame:
    """Add ``merged``: declared properties of the first two levels, merged over entries.

    A document with several entries loses its list flags unless ``keep_is_list``.
    """
    single = "true" if keep_is_list else "size(entries) = 1"

    def merge(path: str, _: str) -> str:
        return let(
            keep("properties", lambda p, _: f"{p}.path = {path}"),
            lambda g: f"""named_struct('path', {path},
                'is_list', {single} AND {some(g, lambda p: f'{p}.is_list')}, 'required', get({g}, 0).required,
                'has_children', {some(g, lambda p: f'{p}.has_children')},
                'checks', {_merge_checks(f'flatten({g}.checks)')})""",
        )

    df = flatten_properties(specs, levels=2, below=False).withColumn("merged", F.expr(each("array_distinct(properties.path)", merge)))
    return df.drop("properties")


# fixed value: the numeric prefix a lenient float parser reads
_NUMBER_PREFIX = r"r'^\s*([+-]?(Infinity|[0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?))'"


def _bound(key: str, side: int, unbounded: str) -> str:
    """Numeric value of one side of a range; NULL when it cannot be read."""
    part = f"get(split({key}, ','), {side})"
    prefix = f"regexp_extract({part}, {_NUMBER_PREFIX}, 1)"
    return f"""CASE WHEN coalesce({part}, '') = '' THEN double('{unbounded}')
        WHEN {prefix} <> '' THEN try_cast({prefix} AS double) END"""


def allowed_values(key: str) -> str:
    """Strings in a JSON array, as keys of a map; NULL when the text is not a JSON array (SQL).

    Numbers never equal a value's text, so only string entries are kept.  A map is searched without
    the exception that ends a search in an array.
    """

    def strings(v: str) -> str:
        found = keep(f"try_variant_get({v}, '$', 'array<variant>')", lambda e, _: f"schema_of_variant({e}) = 'STRING'")
        texts = f"array_distinct({each(found, lambda e, _: f"try_variant_get({e}, '$', 'string')")})"
        keys = let(texts, lambda t: f"map_from_arrays({t}, {each(t, lambda x, _: 'true')})")
        return f"CASE WHEN startswith(schema_of_variant({v}), 'ARRAY') THEN {keys} END"

    return let(f"try_parse_json({key})", strings)


def _gated(merged: DataFrame) -> DataFrame:
    """Add ``_regexes``, the distinct patterns of a document, and ``_gated``, their usable forms or NULL."""
    regexes = each("merged", lambda p, _: let(keep(f"{p}.checks", lambda c, _: f"{c}.kind = 'regex'"), lambda c: f"{c}.key"))
    # the gate is a Python helper: it runs before, and apart from, the array expressions
    df = merged.withColumn("_regexes", F.expr(f"array_distinct(flatten({regexes}))"))
    return df.withColumn("_java", translate(F.col("_regexes"))).withColumn("_gated", F.expr(compiled_only("_java")))


def skipped_patterns(df: DataFrame, keys: list[str], text: str = "spec_json") -> DataFrame:
    """The keys' patterns that validation skips, as unsafe or as ones that do not compile."""
    skipped = F.expr("filter(_regexes, (r, i) -> get(_gated, i) IS NULL)")
    return unnest(_gated(merge_constraints(read_specs(df, text))), keys, skipped, "pattern")


def compile_specs(specs: DataFrame, keys: list[str], keep_is_list: bool = False) -> DataFrame:
    """One row per lookup key, ready for the validator.

    Columns: the keys, ``metadata``, ``all_ids``, ``patterns`` and ``plan``, a
    map from top-level property name to its checks and its children's checks.
    ``plan`` is NULL for a known-absent specification.
    """
    df = _gated(merge_constraints(specs, keep_is_list))

    def ready(c: str, _: str) -> str:
        low, high = _bound(f"{c}.key", 0, "-Infinity"), _bound(f"{c}.key", 1, "Infinity")
        return let(
            f"CASE WHEN {c}.kind = 'minmax' THEN struct({low} AS low, {high} AS high) END",
            lambda b: f"""named_struct('kind', {c}.kind, 'key', {c}.key,
                'allowed', CASE WHEN {c}.kind = 'allowed' THEN {allowed_values(c + '.key')} END,
                'low', CASE WHEN {b}.high IS NOT NULL THEN {b}.low END,
                'high', CASE WHEN {b}.low IS NOT NULL THEN {b}.high END,
                'pattern', CASE WHEN {c}.kind = 'regex' THEN get(_gated, CAST(array_position(_regexes, {c}.key) AS int) - 1) END,
                'event_ids', {c}.event_ids)""",
        )

    def rule(p: str, name: str) -> str:
        return f"""'name', {name}, 'is_list', {p}.is_list, 'required', {p}.required,
            'has_children', {p}.has_children, 'only_ranges', NOT {some(p + '.checks', lambda c: f"{c}.kind <> 'minmax'")},
            'checks', {each(p + '.checks', ready)}"""

    def entry(p: str, _: str) -> str:
        kids = keep("merged", lambda k, _: f"(size({k}.path) = 2 AND get({k}.path, 0) = get({p}.path, 0))")
        ruled = each(kids, lambda k, _: f"named_struct({rule(k, f'get({k}.path, 1)')})")
        return f"struct(get({p}.path, 0) AS key, named_struct({rule(p, f'get({p}.path, 0)')}, 'kids', {ruled}) AS value)"

    top = keep("merged", lambda p, _: f"size({p}.path) = 1")
    return df.select(
        *keys,
        "metadata",
        F.expr(all_event_ids("entries")).alias("all_ids"),
        F.filter("_gated", lambda p: p.isNotNull()).alias("patterns"),
        F.expr(f"map_from_entries({each(top, entry)})").alias("plan"),
    )


@dataclass
class SpecTable:
    """A compiled specification table, its lookup keys and what is known of its size."""

    df: DataFrame
    keys: list[str]
    small: bool = False
    patterns: list[str] = field(default_factory=list)


def load_specs(
    df: DataFrame, keys: list[str], text: str = "spec_json", keep_is_list: bool = False, order: str | None = None
) -> SpecTable:
    """Compile wire documents, and measure them to choose the join.

    Of several documents of one key the last by ``order`` counts, and of equal ones (or
    without an ``order``) the one that sorts last as text, so a lookup never multiplies rows.

    The first measuring job reads the document texts only, a second one the compiled table.  A table over
    ``BROADCAST_BYTES`` is joined by shuffle; beyond ``LITERAL_PATTERNS``
    distinct patterns the patterns stay a column.
    """
    rank = F.struct(*([order] if order else []), text)
    df = df.groupBy(*keys).agg(F.max(rank)[text].alias(text))
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    compiled = compile_specs(read_specs(df, text), keys, keep_is_list)
    small = size <= BROADCAST_BYTES
    patterns = []
    if small:
        # small enough to compute once and keep; what is sent is the compiled form
        compiled = settle(compiled)
        sent = compiled.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
        small = sent <= BROADCAST_BYTES
    if small:
        found = unnest(compiled, [], F.col("patterns"), "p").distinct().limit(LITERAL_PATTERNS + 1).collect()
        patterns = sorted(r["p"] for r in found) if len(found) <= LITERAL_PATTERNS else []
    return SpecTable(compiled, keys, small, patterns)
