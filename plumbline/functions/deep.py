"""Arrow helpers for the JSON values the column expressions do not finish: those below the opened levels.

Each takes NULL for a row that needs no help and hands NULL back.
"""

from __future__ import annotations

import json
import re
import sys
from json.encoder import encode_basestring

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPEN, CLOSE = "\u0001", "\u0002"
# around a value that is still to be sealed
VALUE, END = "\u0003", "\u0004"
_INDEX_KEY = re.compile(r"^(0|[1-9][0-9]{0,9})\Z")
#: escapes of a JSON string: a backslash, or a control character
_ESCAPE = re.compile(r"(\\\\)|\\u00([0-9a-f]{2})")
_NAMES = {type(None): "null", bool: "boolean", str: "string", list: "list", dict: "object"}
_FENCE = re.compile(f"{OPEN}(.*?){CLOSE}", re.S)

DEEP_NODE = T.ArrayType(
    T.StructType(
        [
            T.StructField("path", T.ArrayType(T.StringType())),
            T.StructField("name", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("ord", T.IntegerType()),
            T.StructField("list_types", T.ArrayType(T.StringType())),
        ]
    )
)


def column_argument(column: Column) -> Column:
    """Use a computed column as the argument of an Arrow function.

    Naming it twice keeps the optimizer from inlining its expression: Spark
    does not find an Arrow function again whose argument holds nested lambdas.
    """
    return F.when(column.isNotNull(), column)


def finish_documents(fenced: Column, marked: bool = False) -> Column:
    """Replace each fenced JSON text in a document by its children document.

    ``marked`` leaves the JSON text of each scalar member between marks, as its encrypted value.
    """
    return F.pandas_udf(_finish_marked if marked else _finish, T.StringType())(fenced)


def nodes_in(fenced: Column) -> Column:
    """The fenced value itself, as a node without path and name, and the property nodes inside its text."""
    return F.arrow_udf(_nodes, DEEP_NODE)(column_argument(fenced))


def declared_below(parents: Column) -> Column:
    """Declared properties below each parent, at any depth, as JSON text.

    ``parents`` is JSON text of an array of ``{path, event_ord, base_event_id, children}``.
    """
    return F.pandas_udf(_declared, T.StringType())(column_argument(parents))


def number_text(value: float) -> str:
    """A double as JavaScript prints it."""
    if value == 0:
        return "0"
    size = abs(value)
    if value.is_integer() and size < 1e21:
        digits, _, power = repr(value).partition("e")
        if not power:
            return digits.removesuffix(".0")
        whole, _, part = digits.partition(".")
        return whole + part.ljust(int(power), "0")
    if 1e-6 <= size < 1e21:
        text = repr(value)
        if "e" not in text:
            return text
        digits, _, power = text.lstrip("-").partition("e")
        return ("-" if value < 0 else "") + "0." + "0" * (-int(power) - 1) + digits.replace(".", "")
    digits, _, power = repr(value).partition("e")
    return f"{digits}e{int(power):+d}"


def type_name(value) -> str:
    kind = type(value)
    if kind is int:
        # an integer that prints with an exponent has a point where it has several digits
        return "int" if abs(value) < 10**21 else type_name(_double(value))
    if kind is float:
        if 1e-6 <= abs(value) < 1e21:
            return "int" if value.is_integer() else "float"
        return "float" if "." in number_text(value) or value - value != 0 else "int"
    return _NAMES[kind]


def _double(value: int) -> float:
    try:
        return float(value)
    except OverflowError:
        return float("inf") if value > 0 else float("-inf")


def _kept(values: list) -> list:
    """List elements without repeats of a scalar type."""
    seen, kept = set(), []
    for value in values:
        name = type_name(value)
        if name in ("null", "list", "object") or name not in seen:
            kept.append(value)
        seen.add(name)
    return kept


def _members(value: dict) -> list:
    """Members with index-like names first, in numeric order."""
    if not any("0" <= k[:1] <= "9" for k in value):
        return list(value.items())
    index = lambda k: _INDEX_KEY.match(k) and int(k) < 4294967295
    first = sorted((k for k in value if index(k)), key=int)
    return [(k, value[k]) for k in first] + [(k, v) for k, v in value.items() if not index(k)]


def _quoted(text: str) -> str:
    """JSON string literal, the same as that of the column expressions."""
    out = encode_basestring(text)
    if "\\u00" in out:
        out = _ESCAPE.sub(lambda m: m[1] or f"\\u00{m[2].upper()}", out)
    return out


def _children_text(value, marked: bool) -> str:
    if isinstance(value, dict):
        return "[" + ",".join([_member_text(k, v, marked) for k, v in _members(value)]) + "]"
    if isinstance(value, list):
        return "[" + ",".join([_children_text(v, marked) for v in _kept(value)]) + "]"
    return "[]" if value is None else f'"{type_name(value)}"'


def _scalar_text(value) -> str:
    if type(value) is int and not -(1 << 63) <= value < 1 << 63:
        value = _double(value)
    if isinstance(value, float):
        return number_text(value)
    return _quoted(value) if isinstance(value, str) else json.dumps(value)


def _member_text(name: str, value, marked: bool) -> str:
    if isinstance(value, (dict, list)):
        more = f',"children":{_children_text(value, marked)}'
    else:
        more = f',"encryptedPropertyValue":"{VALUE}{_scalar_text(value)}{END}"' if marked else ""
    return f'{{"propertyName":{_quoted(name)},"propertyType":"{type_name(value)}"{more}}}'


def _finished(fenced: pd.Series, marked: bool) -> pd.Series:
    if fenced.isna().all():
        return fenced
    replace = lambda text: _FENCE.sub(lambda m: _children_text(json.loads(m[1]), marked), text)
    return fenced.map(replace, na_action="ignore")


def _finish(fenced: pd.Series) -> pd.Series:
    return _finished(fenced, False)


def _finish_marked(fenced: pd.Series) -> pd.Series:
    return _finished(fenced, True)


# fixed values: constraint kinds in checking order, with their wire names
_KINDS = (("pinned", "p"), ("allowed", "v"), ("regex", "rx"), ("minmax", "minmax"))


def _declared_checks(wire: dict, event_ord: int) -> list:
    checks = []
    for rank, (kind, name) in enumerate(_KINDS):
        found = wire.get(name)
        for i, (key, ids) in enumerate(found.items() if isinstance(found, dict) else ()):
            order = int(key) - (1 << 34) if _INDEX_KEY.match(key) else i
            ids = ids if isinstance(ids, list) else None
            checks.append({"rank": rank, "event_ord": event_ord, "key_ord": order, "kind": kind, "key": key, "event_ids": ids})
    return checks


def _declared_in(text: str) -> str:
    out, level = [], json.loads(text)
    while level:
        below = []
        for parent in level:
            children = parent["children"]
            children = json.loads(children) if isinstance(children, str) else children
            for i, (name, wire) in enumerate(children.items() if isinstance(children, dict) else ()):
                wire = wire if isinstance(wire, dict) else {}
                row = {"event_ord": parent["event_ord"], "base_event_id": parent.get("base_event_id"), "path": [*parent["path"], name], "prop_ord": i}
                kids = wire.get("children")
                out.append(
                    row
                    | {"type": wire.get("t"), "required": wire.get("r") is True, "is_list": wire.get("l") is True, "has_children": kids is not None}
                    | {"checks": _declared_checks(wire, parent["event_ord"])}
                )
                if kids is not None:
                    below.append(row | {"children": kids})
        level = below
    return json.dumps(out)


def _declared(parents: pd.Series) -> pd.Series:
    return parents.map(_declared_in, na_action="ignore")


class _Nodes:
    """Property nodes of many values, as columns; lists are cut by their ends."""

    def __init__(self) -> None:
        self.name: list = []
        self.type: list = []
        self.ord: list = []
        self.path: list = []
        self.path_ends = [0]
        self.types: list = []
        self.types_ends = [0]
        self.no_types: list = []

    def add(self, path: list, name: str | None, value, i: int) -> None:
        kind = type_name(value)
        self.name.append(name)
        self.type.append(kind)
        self.ord.append(i)
        self.path += path
        self.path_ends.append(len(self.path))
        if kind == "list":
            self.types += [n for n in map(type_name, _kept(value)) if n not in ("null", "list", "object")]
        self.types_ends.append(len(self.types))
        self.no_types.append(kind != "list")

    def walk(self, value, path: list) -> None:
        named = isinstance(value, dict)
        steps = _members(value) if named else ((str(i), v) for i, v in enumerate(_kept(value)))
        for i, (step, child) in enumerate(steps):
            here = [*path, step]
            if named:
                self.add(here, step, child, i)
            if isinstance(child, (dict, list)):
                self.walk(child, here)

    def arrays(self) -> list:
        of = lambda ends, values, mask=None: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.string()), mask=mask)
        return [
            of(self.path_ends, self.path),
            pa.array(self.name, pa.string()),
            pa.array(self.type, pa.string()),
            pa.array(self.ord, pa.int32()),
            of(self.types_ends, self.types, pa.array(self.no_types, pa.bool_())),
        ]


def _nodes(fenced: pa.Array) -> pa.Array:
    out, ends, missing = _Nodes(), [0], []
    for text in fenced.to_pylist():
        missing.append(text is None)
        if text is not None:
            value = json.loads(text)
            out.add([], None, value, 0)
            out.walk(value, [])
        ends.append(len(out.name))
    structs = pa.StructArray.from_arrays(out.arrays(), names=["path", "name", "type", "ord", "list_types"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs, mask=pa.array(missing, pa.bool_()))
