"""Schema documents and schema rows of a property object, one row in, one row out.

A property object is opened level by level into columns ``<prefix>0``,
``<prefix>1`` and so on: level 0 is an array of members, level 1 an array (per
member) of arrays of children, and so forth.  Documents are then put together
bottom-up with array expressions, so they cost no explode and no shuffle.

Values below the last opened level are fenced with two control characters,
which JSON text cannot hold unescaped.  A small Arrow function finishes those;
it receives NULL for every row without a fence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.deep import CLOSE, END, OPEN, VALUE, finish_documents
from plumbline.functions.planning import pin
from plumbline.functions.values import (
    MEMBERS,
    children_of,
    each,
    is_nested,
    json_text,
    keep,
    let,
    members,
    quoted,
    some,
)

#: members and their children, which validation results name; helpers finish what is below
DEFAULT_DEPTH = 2
#: column that holds the key of sealed values while a document is put together
SEAL_KEY = "_seal_key"


def _each_deep(array: str, depth: int, body: Callable[[str, tuple], str], at: tuple = ()) -> str:
    """Map ``body(element, indexes)`` over an array nested ``depth`` levels deep."""
    if depth == 0:
        return each(array, lambda x, i: body(x, at + (i,)))
    return each(array, lambda x, i: _each_deep(x, depth - 1, body, at + (i,)))


def _at(array: str, indexes: tuple) -> str:
    for i in indexes:
        array = f"get({array}, {i})"
    return array


def is_scalar(node: str) -> str:
    return f"{node}.type NOT IN ('object', 'list', 'null')"


def first_of_its_type(kids: str) -> str:
    """Keep one entry per scalar type name; null and nested elements all stay."""
    return keep(
        kids, lambda k, i: f"(NOT {is_scalar(k)} OR array_position({kids}.type, {k}.type) = {i} + 1)"
    )


def open_levels(df: DataFrame, raw: str, prefix: str = "_level", max_depth: int = DEFAULT_DEPTH) -> DataFrame:
    """Add the level columns of the JSON object column ``raw``."""
    df = df.withColumn(f"{prefix}0", F.expr(f"coalesce({members(raw)}, CAST(array() AS {MEMBERS}))"))
    for depth in range(1, max_depth):
        above = f"{prefix}{depth - 1}"
        if depth == 1:
            above = f"CASE WHEN {some(above, is_nested)} THEN {above} END"
        kept = lambda node, at: let(
            children_of(node),
            lambda kids: f"CASE WHEN {node}.type = 'list' THEN {first_of_its_type(kids)} ELSE {kids} END",
        )
        df = df.withColumn(f"{prefix}{depth}", F.expr(_each_deep(above, depth - 1, kept)))
    return df


def _ids(name: str, ids: str) -> str:
    return f"""CASE WHEN {ids} IS NOT NULL THEN concat(',"{name}":', to_json({ids})) ELSE '' END"""


def add_schema_document(
    df: DataFrame,
    out: str,
    prefix: str = "_level",
    results: str | None = None,
    seal: Callable[[str], str] | None = None,
    max_depth: int = DEFAULT_DEPTH,
) -> DataFrame:
    """Nested schema document (B4) from opened levels.

    ``results`` names a column of per-member validation results to merge in
    (C16): they reach members and, under an object, its children.  ``seal``
    turns the JSON text of a scalar member into an encrypted value; members below
    the opened levels are sealed as well.
    """

    def result_of(node: str, at: tuple) -> str | None:
        if results is None or len(at) > 2:
            return None
        own = f"get({results}, {at[0]})"
        if len(at) == 1:
            return own
        return f"get({keep(own + '.children', lambda r, _: f'{r}.name = {node}.name')}, 0)"

    def text(below: str | None) -> Callable[[str, tuple], str]:
        def one(node: str, at: tuple) -> str:
            if below is None:
                kids = f"CASE WHEN {is_nested(node)} THEN concat('{OPEN}', {node}.raw, '{CLOSE}') END"
            else:
                kids = f"concat('[', array_join({_at(below, at)}, ','), ']')"
            extras = []
            if seal is not None:
                value = f"CASE WHEN NOT {is_nested(node)} THEN {seal(json_text(node))} END"
                extras.append(f"""coalesce(concat(',"encryptedPropertyValue":"', {value}, '"'), '')""")
            extras.append(f"""coalesce(concat(',"children":', {kids}), '')""")
            result = result_of(node, at)
            if result is not None:
                extras += [_ids("failedEventIds", f"{result}.failed"), _ids("passedEventIds", f"{result}.passed")]
            member = f"""concat('{{"propertyName":', {quoted(node + '.name')}, ',"propertyType":"', {node}.type, '"',
                {', '.join(extras)}, '}}')"""
            bare = f"""CASE WHEN {node}.type = 'null' THEN '[]' ELSE concat('"', {node}.type, '"') END"""
            return f"CASE WHEN {node}.name IS NOT NULL THEN {member} ELSE coalesce({kids}, {bare}) END"

        return one

    if hasattr(seal, "attach"):
        df = seal.attach(df)
    below = None
    temporary = []
    for depth in range(max_depth - 1, -1, -1):
        name = f"_text{depth}"
        df = df.withColumn(name, F.expr(_each_deep(f"{prefix}{depth}", depth, text(below))))
        below = name
        temporary.append(name)
    # pinned: built once, and a plain column for the Arrow function
    df = pin(df, out, F.expr(f"concat('[', array_join({below}, ','), ']')")).drop(*temporary)
    fenced = F.expr(f"CASE WHEN contains({out}, '{OPEN}') THEN {out} END")
    finished = finish_documents(fenced, marked=seal is not None)
    if seal is None:
        return df.withColumn(out, F.coalesce(finished, F.col(out)))
    # the helper leaves the values to seal between marks: every second part of the text
    df = pin(df, "_finished", finished)
    parts = f"split(_finished, '[{VALUE}{END}]')"
    sealed = each(parts, lambda p, i: f"CASE WHEN {i} % 2 = 1 THEN {seal(p)} ELSE {p} END")
    return df.withColumn(out, F.coalesce(F.expr(f"array_join({sealed}, '')"), F.col(out))).drop("_finished", SEAL_KEY)


def drop_levels(df: DataFrame, prefix: str = "_level") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


NODE = "struct<path:array<string>,name:string,type:string,ord:int,list_types:array<string>,fenced:string>"


def schema_nodes(prefix: str = "_level", max_depth: int = DEFAULT_DEPTH) -> Column:
    """All properties of the opened object, at every level, as one flat array (B2).

    ``path`` holds member names and, under a list, the position among the
    list's kept children.  ``list_types`` are a list's scalar type names in
    first-seen order (B3).  ``fenced`` is the text of a nested value below the
    last level; see ``deep.nodes_in``.
    """

    def node(n: str, at: tuple) -> str:
        last = len(at) == max_depth
        steps = [
            f"coalesce({_at(f'{prefix}{d}', at[: d + 1])}.name, CAST({at[d]} AS string))" for d in range(len(at))
        ]
        types, fenced = "NULL", "NULL"
        if last:
            fenced = f"CASE WHEN {is_nested(n)} THEN {n}.raw END"
        else:
            scalars = keep(_at(f"{prefix}{len(at)}", at), lambda k, _: is_scalar(k))
            types = f"CASE WHEN {n}.type = 'list' THEN {let(scalars, lambda s: f'{s}.type')} END"
        return f"""named_struct('path', array({', '.join(steps)}), 'name', {n}.name, 'type', {n}.type,
            'ord', {at[-1]}, 'list_types', CAST({types} AS array<string>), 'fenced', CAST({fenced} AS string))"""

    flat = []
    for depth in range(max_depth):
        nodes = _each_deep(f"{prefix}{depth}", depth, node)
        for _ in range(depth):
            nodes = f"flatten({keep(nodes, lambda a, _: f'{a} IS NOT NULL')})"
        flat.append(f"coalesce({nodes}, CAST(array() AS array<{NODE}>))")
    return F.expr(keep(f"concat({', '.join(flat)})", lambda n, _: f"({n}.name IS NOT NULL OR {n}.fenced IS NOT NULL)"))
