"""Validation of property values against a specification.

Each event carries its own rules after the lookup join, so all checks are array
expressions over one row: no explode, no shuffle, and an event name that holds
most of the rows is just more rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.patterns import matches
from plumbline.functions.planning import pin, unnest
from plumbline.functions.values import (
    each,
    flat_fields,
    has_nested_fields,
    items_of,
    keep,
    let,
    members,
    number_of,
    scalar_number,
    scalar_text,
    some,
    value_text,
    when,
)

_NONE = "CAST(array() AS array<string>)"


def comparable(node: str) -> str:
    """Type, text and number of a value; a missing one has type and text ``undefined``."""
    return f"""named_struct('type', coalesce({node}.type, 'undefined'),
        'text', coalesce({value_text(node)}, 'undefined'), 'number', {number_of(node)})"""


def measured(node: str) -> str:
    """``comparable`` where only ranges are checked, which need no text."""
    return f"named_struct('type', coalesce({node}.type, 'undefined'), 'text', CAST(NULL AS string), 'number', {number_of(node)})"


def flat_comparable(v: str, kind: str) -> str:
    """``comparable`` of a variant that isn't nested, or is missing.  Of its type no check asks more than whether it is a string."""
    text = when(f"{kind} IS NULL", "'undefined'", f"coalesce({scalar_text(v, kind)}, 'undefined')")
    return f"named_struct('type', if({kind} = 'STRING', 'string', 'other'), 'text', {text}, 'number', {scalar_number(v, kind)})"


def outside(number: str, check: str) -> str:
    """Does a number, or NULL for any other value, break a range?"""
    return f"({number} IS NULL OR ({check}.low IS NOT NULL AND ({number} < {check}.low OR {number} > {check}.high)))"


def violates(x: str, check: str, patterns: list[str]) -> str:
    """Does a value break one check (C3-C6)?  Unusable keys and patterns never fail a value."""
    allowed = f"{check}.allowed IS NOT NULL AND try_element_at({check}.allowed, {x}.text) IS NULL"
    regex = f"""{x}.type <> 'string'
        OR ({check}.pattern IS NOT NULL AND NOT ({matches(f'{x}.text', f'{check}.pattern', patterns)}))"""
    broken = when(
        f"{check}.kind = 'pinned'", f"{x}.text <> {check}.key",
        f"{check}.kind = 'allowed'", allowed,
        f"{check}.kind = 'minmax'", outside(f"{x}.number", check),
        f"{check}.kind = 'regex'", regex,
        "false",
    )
    return f"coalesce({broken}, false)"


def _holds(ids: str, one: str) -> str:
    """``array_contains`` of a short list that isn't empty; that one leaves its loop by an exception for each hit."""
    return some(ids, lambda x: f"{x} = {one}")


def _prefers_passed(failed: str, passed: str) -> str:
    return f"(size({passed}) < size({failed}) AND size({passed}) > 0)"


def _passed(failed: str) -> str:
    return keep("all_ids", lambda i, _: f"NOT {_holds(failed, i)}")


def compact(failed: str) -> str:
    """Keep the shorter id list; ``failed`` on a tie, nothing when none failed."""
    shorter = let(
        _passed(failed),
        lambda p: when(
            _prefers_passed(failed, p),
            f"named_struct('failed', CAST(NULL AS array<string>), 'passed', {p})",
            f"named_struct('failed', {failed}, 'passed', CAST(NULL AS array<string>))",
        ),
    )
    return when(f"size({failed}) > 0", shorter, "NULL")


def _ids_of(broken: str) -> str:
    """Ids of the broken checks, in checking order."""
    return let(broken, lambda k: when(f"size({k}) > 0", f"array_distinct(flatten({k}.event_ids))", _NONE))


def _failures(node: str, rule: str, patterns: list[str]) -> str:
    """Ids that fail for one value, in checking order."""
    value = when(f"{rule}.only_ranges", measured(node), comparable(node))
    broken = let(value, lambda x: keep(f"{rule}.checks", lambda c, _: violates(x, c, patterns)))
    return when(f"size({rule}.checks) > 0", _ids_of(broken), _NONE)


def _union(lists: str) -> str:
    return f"coalesce(array_distinct(flatten({lists})), {_NONE})"


def _list_failures(node: str, rule: str, patterns: list[str]) -> str:
    """Any failing item fails the id; null items are checked too."""
    return _union(each(items_of(node), lambda item, _: _failures(item, rule, patterns)))


def _skipped(node: str, rule: str) -> str:
    """Null or missing on an optional property is not checked."""
    return f"(coalesce({node}.type, 'null') = 'null' AND NOT {rule}.required)"


def _child_failures(node: str, rule: str, patterns: list[str]) -> str:
    """Failures of a child value; its own children are below the depth limit."""
    listed = _list_failures(node, rule, patterns)
    return f"""coalesce(CASE WHEN {rule}.has_children THEN {_NONE}
        WHEN {rule}.is_list THEN CASE WHEN {node}.type = 'list' THEN {listed} END
        WHEN {_skipped(node, rule)} THEN {_NONE}
        ELSE {_failures(node, rule, patterns)} END, {_NONE})"""


def _flat_broken(fields: str, rule: str, patterns: list[str]) -> str:
    """Which checks a child that isn't nested breaks, as booleans; NULL where it is not checked.

    ``fields`` is the parent as a map of variants.
    """

    def told(v: str, kind: str) -> str:
        ranges = let(scalar_number(v, kind), lambda x: each(f"{rule}.checks", lambda c, _: outside(x, c)))
        others = let(flat_comparable(v, kind), lambda x: each(f"{rule}.checks", lambda c, _: violates(x, c, patterns)))
        skipped = f"NOT {rule}.required AND coalesce({kind}, 'VOID') = 'VOID'"
        return when(skipped, "NULL", f"{rule}.only_ranges", ranges, others)

    return let(f"try_element_at({fields}, {rule}.name)", lambda v: let(f"schema_of_variant({v})", lambda kind: told(v, kind)))


def _flat_ids(broken: str, rule: str) -> str:
    """Ids of the checks that ``broken`` marks."""
    ids = _ids_of(keep(f"{rule}.checks", lambda _, i: f"get({broken}, {i})"))
    return when(some(broken, lambda x: x), ids, _NONE)


def _unnested(rule: str, failures: str) -> str:
    """``failures`` of a rule for scalars; a value that isn't nested fails no other one."""
    return when(f"{rule}.has_children OR {rule}.is_list", _NONE, failures)


def _named(nodes: str, name: str) -> str:
    return f"get({keep(nodes, lambda n, _: f'{n}.name = {name}')}, 0)"


def _child_results(rules: str, failures_of) -> str:
    """Non-empty results per declared child; NULL when there is none."""
    row = lambda r, failed, passed: f"""named_struct('name', {r}.name,
        'failed', CAST({failed} AS array<string>), 'passed', CAST({passed} AS array<string>))"""
    shorter = lambda r, f: let(_passed(f), lambda p: when(_prefers_passed(f, p), row(r, "NULL", p), row(r, f, "NULL")))
    results = each(rules, lambda r, _: let(failures_of(r), lambda f: when(f"size({f}) > 0", shorter(r, f), "NULL")))
    found = keep(results, lambda r, _: f"{r} IS NOT NULL")
    return let(found, lambda f: when(f"size({f}) > 0", f, "NULL"))


def add_results(df: DataFrame, out: str = "results", prefix: str = "_level", patterns: list[str] = ()) -> DataFrame:
    """Validate opened events against the joined ``plan`` and ``all_ids``.

    ``out`` is aligned with the members of level 0: a member without rules, or
    without failures, has an empty result.  It is NULL without a specification.

    All of it is one expression.  Only its result becomes a column, so the rules
    joined to an event are read in place and never copied from step to step.
    """
    patterns = list(patterns)

    # children are read from the variant that is there already; only where one is nested itself is
    # the text opened, which keeps the order of its members

    def object_kids(m: str, rule: str) -> str:  # C11
        def opened(kids: str):
            return lambda r: let(_named(kids, f"{r}.name"), lambda n: _child_failures(n, r, patterns))

        def flat(fields: str):
            failed = lambda r: let(_flat_broken(fields, r, patterns), lambda b: _flat_ids(b, r))
            return lambda r: _unnested(r, failed(r))

        is_object = lambda value: f"CASE WHEN {m}.type = 'object' THEN {value} END"
        nested = let(is_object(members(f"{m}.raw")), lambda kids: _child_results(f"{rule}.kids", opened(kids)))
        plain = let(is_object(flat_fields(f"{m}.v")), lambda fields: _child_results(f"{rule}.kids", flat(fields)))
        return f"CASE WHEN {has_nested_fields(f'{m}.raw')} THEN {nested} ELSE {plain} END"

    def item_failures(failures: str) -> str:
        # an item whose shorter list is the passed one stands for the rest of all ids
        known = lambda f: keep("all_ids", lambda i, _: _holds(f, i))
        prefers = lambda f: let(_passed(f), lambda p: _prefers_passed(f, p))
        return let(failures, lambda f: when(f"size({f}) = 0", f, prefers(f), known(f), f))

    def item_kids(m: str, rule: str) -> str:  # C10
        def opened(items: str):
            failed = lambda r, kids: let(_named(kids, f"{r}.name"), lambda n: _child_failures(n, r, patterns))
            return lambda r: _union(each(items, lambda kids, _: item_failures(failed(r, kids))))

        def flat(items: str):
            # items that break the same checks fail the same ids, which are worked out once
            ways = lambda r: f"array_distinct({each(items, lambda fields, _: _flat_broken(fields, r, patterns))})"
            return lambda r: _unnested(r, _union(each(ways(r), lambda b, _: item_failures(_flat_ids(b, r)))))

        texts = each(items_of(m), lambda i, _: members(f"{i}.raw"))
        nested = let(texts, lambda o: _child_results(f"{rule}.kids", opened(o)))
        listed = f"CASE WHEN {m}.type = 'list' THEN try_variant_get({m}.v, '$', 'array<variant>') END"
        plain = let(each(listed, lambda i, _: flat_fields(i)), lambda o: _child_results(f"{rule}.kids", flat(o)))
        return f"CASE WHEN {has_nested_fields(f'{m}.raw')} THEN {nested} ELSE {plain} END"

    def own(m: str, rule: str) -> str:
        return f"""coalesce(CASE WHEN {rule}.has_children THEN {_NONE}
            WHEN {rule}.is_list THEN CASE WHEN {m}.type = 'list' THEN {_list_failures(m, rule, patterns)} END
            WHEN {_skipped(m, rule)} THEN {_NONE}
            ELSE {_failures(m, rule, patterns)} END, {_NONE})"""

    def one(m: str, _: str) -> str:
        def with_rule(rule: str) -> str:
            kids = f"""CASE WHEN {rule}.has_children THEN
                CASE WHEN {rule}.is_list THEN {item_kids(m, rule)} ELSE {object_kids(m, rule)} END END"""
            checked = let(
                let(own(m, rule), compact),
                lambda c: f"named_struct('name', {m}.name, 'failed', {c}.failed, 'passed', {c}.passed, 'children', {kids})",
            )
            free = f"named_struct('name', {m}.name, 'failed', NULL, 'passed', NULL, 'children', NULL)"
            return f"CASE WHEN {rule} IS NULL THEN {free} ELSE {checked} END"

        return let(f"try_element_at(plan, {m}.name)", with_rule)

    return pin(df, out, F.expr(f"CASE WHEN plan IS NOT NULL THEN {each(f'{prefix}0', one)} END"))


def property_results(df: DataFrame, keys: list[str], results: str = "results") -> DataFrame:
    """Long form: one row per observed property, plus one per child with failures."""
    row = lambda name, child, r: F.struct(
        name.alias("property"), child.alias("child"), r["failed"].alias("failed"), r["passed"].alias("passed")
    )
    rows = F.transform(
        results,
        lambda r: F.concat(
            F.array(row(r["name"], F.lit(None).cast("string"), r)),
            F.coalesce(F.transform(r["children"], lambda c: row(r["name"], c["name"], c)), F.array()),
        ),
    )
    return unnest(df, keys, F.flatten(rows), "r").select(*keys, "r.*")


def failing_properties(df: DataFrame, keys: list[str], results: str = "results") -> DataFrame:
    """Top-level properties that report failed ids (C17)."""
    failing = F.filter(results, lambda r: F.size(r["failed"]) > 0)
    rows = unnest(df, keys, failing, "r")
    return rows.select(*keys, F.col("r.name").alias("property"), F.col("r.failed").alias("failed"))
