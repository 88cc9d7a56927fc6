"""JSON values as JavaScript sees them, written as Spark SQL expressions.

A property object arrives as JSON text.  ``members`` and ``items`` open one
level of it into an array of ``struct<name, type, v, raw>``: ``v`` is the typed
variant and ``raw`` the text of a nested value, which keeps member order (a
variant sorts its keys).  Nothing here leaves the JVM or needs a shuffle.

All builders take and give SQL text: lambdas nest deeply here, and one parsed
expression is far cheaper to set up than thousands of column calls.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

MEMBERS = "array<struct<name:string,type:string,v:variant,raw:string>>"

# fixed values: an object key that JavaScript treats as an array index and lists first
_INDEX_KEY = "r'^(0|[1-9][0-9]{0,9})$'"
_INDEX_LIMIT = 4294967295
# such a name in the text of an object
_INDEX_NAME = r"""r'"[0-9]{1,10}"\s*:'"""

_names = count()


def fresh(prefix: str = "x") -> str:
    """A lambda variable no enclosing lambda uses."""
    return f"{prefix}{next(_names)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """Bind ``value`` once for ``body``; lambdas get no common-subexpression reuse.

    ``element_at`` keeps its result type, where ``get`` works it out anew for
    every row, through all of the body.
    """
    x = fresh()
    return f"element_at(transform(array({value}), {x} -> {body(x)}), 1)"


def when(*cases: str) -> str:
    """``CASE`` of tests and values, and a last value, as nested ``if``; a ``CASE`` counts and searches its list of branches for each value."""
    out = cases[-1]
    for test, value in reversed(list(zip(cases[:-1:2], cases[1::2], strict=True))):
        out = f"if({test}, {value}, {out})"
    return out


def each(array: str, body: Callable[[str, str], str]) -> str:
    """Map ``body(element, index)``."""
    x, i = fresh(), fresh("i")
    return f"transform({array}, ({x}, {i}) -> {body(x, i)})"


def keep(array: str, test: Callable[[str, str], str]) -> str:
    """Elements for which ``test(element, index)`` holds."""
    x, i = fresh(), fresh("i")
    return f"filter({array}, ({x}, {i}) -> {test(x, i)})"


def some(array: str, test: Callable[[str], str]) -> str:
    x = fresh()
    return f"exists({array}, {x} -> {test(x)})"


def literal(text: str) -> str:
    """SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def is_nested(node: str) -> str:
    return f"{node}.type IN ('object', 'list')"


def number_type(d: str) -> str:
    """``int`` when the printed JavaScript number has no decimal point, else ``float``."""
    return when(
        f"{d} % 1 = 0 AND abs({d}) < 1e21", "'int'",
        f"abs({d}) >= 1e-6 AND abs({d}) < 1e21", "'float'",
        rf"CAST({d} AS string) RLIKE r'^-?[0-9]\.0E'", "'int'",
        "'float'",
    )


def number_text(d: str) -> str:
    """Text of a double as JavaScript prints it."""
    exponent = rf"regexp_replace(regexp_replace(CAST({d} AS string), r'\.0E', 'E'), r'E(?=[0-9])', 'E+')"
    return f"""CASE WHEN {d} = 0 THEN '0'
        WHEN {d} % 1 = 0 AND abs({d}) < 1e21 THEN CAST(CAST({d} AS decimal(22,0)) AS string)
        WHEN abs({d}) >= 1e-3 AND abs({d}) < 1e7 THEN CAST({d} AS string)
        WHEN abs({d}) >= 1e7 AND abs({d}) < 1e21 THEN regexp_replace(CAST(CAST({d} AS decimal(38,16)) AS string), '0+$', '')
        WHEN abs({d}) >= 1e-6 AND abs({d}) < 1e-3 THEN regexp_replace(CAST(CAST({d} AS decimal(38,30)) AS string), '0+$', '')
        ELSE lower({exponent}) END"""


def _double(v: str) -> str:
    return f"try_variant_get({v}, '$', 'double')"


def property_type(v: str) -> str:
    """Observed type name of a variant value (B1)."""
    return let(
        f"schema_of_variant({v})",
        lambda s: when(
            f"{s} = 'BIGINT'", "'int'",
            f"{s} = 'STRING'", "'string'",
            f"startswith({s}, 'DECIMAL') OR {s} IN ('DOUBLE', 'FLOAT')", let(_double(v), number_type),
            f"{s} = 'BOOLEAN'", "'boolean'",
            f"{s} = 'VOID'", "'null'",
            f"startswith({s}, 'ARRAY')", "'list'",
            f"startswith({s}, 'OBJECT')", "'object'",
            "'unknown'",
        ),
    )


def number_of(node: str) -> str:
    """The double behind a numeric value; NULL for every other type.

    A variant cast to double also accepts numeric strings and booleans, so the
    observed type is tested first.
    """
    return when(f"{node}.type IN ('int', 'float')", _double(node + ".v"), "NULL")


def _has_nested(raw: str) -> str:
    return f"(locate('{{', {raw}, 2) > 0 OR locate('[', {raw}, 2) > 0)"


def _member(name: str, v: str, raw: str) -> str:
    return f"named_struct('name', {name}, 'type', {property_type(v)}, 'v', {v}, 'raw', {raw})"


def _position(name: str) -> str:
    return f"try_to_number({name}, '9999999999')"


def _js_order(entries: str, raw: str) -> str:
    """Last duplicate wins at the first position; index-like names come first.

    ``raw`` is the object's text: without a name of digits in it no member is looked at.
    """
    index_like = lambda x: f"({x}.name RLIKE {_INDEX_KEY} AND {_position(x + '.name')} < {_INDEX_LIMIT})"

    def unique(e: str) -> str:
        first = keep(e, lambda x, i: f"array_position({e}.name, {x}.name) = {i} + 1")
        last = each(first, lambda x, _: f"element_at({keep(e, lambda y, _: f'{y}.name = {x}.name')}, -1)")
        return when(f"size(array_distinct({e}.name)) < size({e})", last, e)

    def indexed_first(e: str) -> str:
        a, b = fresh("a"), fresh("b")
        pa, pb = _position(f"{a}.name"), _position(f"{b}.name")
        ordered = f"""array_sort({keep(e, lambda x, _: index_like(x))},
            ({a}, {b}) -> CASE WHEN {pa} < {pb} THEN -1 WHEN {pa} > {pb} THEN 1 ELSE 0 END)"""
        rest = keep(e, lambda x, _: f"NOT {index_like(x)}")
        maybe = rf"({raw} RLIKE {_INDEX_NAME} OR contains({raw}, r'\u'))"  # an escape may hide one
        return when(f"{maybe} AND {some(e, index_like)}", f"concat({ordered}, {rest})", e)

    return let(let(entries, unique), indexed_first)


def members(raw: str) -> str:
    """Members of a JSON object in JavaScript key order; NULL unless ``raw`` is an object."""
    texts = f"CASE WHEN {_has_nested(raw)} THEN map_values(from_json({raw}, 'map<string,string>')) END"
    opened = let(
        texts,
        lambda text: each(
            f"map_entries(from_json({raw}, 'map<string,variant>'))",
            lambda e, i: _member(f"{e}.key", f"{e}.value", f"get({text}, {i})"),
        ),
    )
    return _js_order(opened, raw)


def items(raw: str) -> str:
    """Elements of a JSON array, as unnamed members."""
    texts = f"CASE WHEN {_has_nested(raw)} THEN from_json({raw}, 'array<string>') END"
    return let(
        texts,
        lambda text: each(
            f"from_json({raw}, 'array<variant>')",
            lambda v, i: _member("CAST(NULL AS string)", v, f"get({text}, {i})"),
        ),
    )


def flat_fields(v: str) -> str:
    """A variant object as a map of variants, without parsing its text again; NULL for anything else."""
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def has_nested_fields(raw: str) -> str:
    """May a member of the object, or of an object in the list, be nested itself?  ``raw`` is compact."""
    return f"(contains({raw}, ':{{') OR contains({raw}, ':['))"


def scalar_number(v: str, kind: str) -> str:
    """``number_of`` of a variant that isn't nested, from its ``schema_of_variant``."""
    return when(f"{kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL')", _double(v), "NULL")


def scalar_text(v: str, kind: str) -> str:
    """``value_text`` of a variant that isn't nested, from its ``schema_of_variant``."""
    return when(
        f"{kind} IN ('STRING', 'BOOLEAN', 'BIGINT')", f"try_variant_get({v}, '$', 'string')",
        f"{kind} = 'VOID'", "'null'",
        let(_double(v), number_text),
    )


def children_of(node: str) -> str:
    """Opened children of a nested member; NULL for a scalar."""
    return f"CASE WHEN {node}.type = 'object' THEN {members(node + '.raw')} WHEN {node}.type = 'list' THEN {items(node + '.raw')} END"


def items_of(node: str) -> str:
    """Elements of a list member; NULL for anything else."""
    return f"CASE WHEN {node}.type = 'list' THEN {items(node + '.raw')} END"


def quoted(text: str) -> str:
    """JSON string literal of ``text``."""
    escaped = rf"regexp_extract(to_json(array({text})), r'(?s)^\[(.*)\]$', 1)"
    return rf"""CASE WHEN {text} RLIKE r'["\\\x00-\x1f]' THEN {escaped} ELSE concat('"', {text}, '"') END"""


def _scalar_text(node: str) -> str:
    return when(
        f"{node}.type = 'null'", "'null'",
        f"{node}.type IN ('string', 'boolean') OR schema_of_variant({node}.v) = 'BIGINT'", f"try_variant_get({node}.v, '$', 'string')",
        let(_double(node + ".v"), number_text),
    )


def value_text(node: str) -> str:
    """String form used in comparisons: scalars printed, nested values as compact JSON."""
    nested = f"CASE WHEN {node}.raw RLIKE r'[0-9](\\.0([^0-9]|$)|E)' THEN {_render(node + '.raw')} ELSE {node}.raw END"
    return when(is_nested(node), nested, _scalar_text(node))


def _render(raw: str) -> str:
    """Source text of a nested value with its numbers printed as JavaScript does.

    The text is already compact and in member order.  With escapes set aside,
    every second piece between quotes is a string; the others split into tokens.
    """
    hidden = rf"replace(replace({raw}, r'\\', '\u0003'), r'\"', '\u0004')"
    number = lambda t: let(f"CAST({t} AS double)", number_text)
    token = lambda t, _: f"CASE WHEN {t} RLIKE r'^-?[0-9]+[.E]' THEN {number(t)} ELSE {t} END"
    boundary = r"r'(?<=[,:\[\]{}])|(?=[,:\[\]{}])'"
    piece = lambda s, i: f"CASE WHEN {i} % 2 = 1 THEN {s} ELSE array_join({each(f'split({s}, {boundary})', token)}, '') END"
    pieces = each(f"split({hidden}, '\"')", piece)
    return rf"replace(replace(array_join({pieces}, '\"'), '\u0004', r'\"'), '\u0003', r'\\')"


def json_text(node: str) -> str:
    """JSON form of a value: strings are quoted, the rest as ``value_text``."""
    string = quoted(f"try_variant_get({node}.v, '$', 'string')")
    return f"CASE WHEN {node}.type = 'string' THEN {string} ELSE {value_text(node)} END"
