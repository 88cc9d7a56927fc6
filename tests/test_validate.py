"""Validation results, exact in both directions."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.catalog.inputs import prop, wire
from plumbline.functions.documents import open_levels
from plumbline.functions.patterns import is_safe, to_java
from plumbline.operators.lookup import lookup_spec
from plumbline.operators.validate import add_results, property_results
from plumbline.sources.specs import load_specs

IDS = ["e", "v1", "v2"]


def check(spark, spec, *props, ids=IDS, document=None, **options):
    """Results per event as {property or property.child: (form, ids)}; nothing for an empty result."""
    specs = spark.createDataFrame([("x", document or wire(spec, ids=ids))], "event_name string, spec_json string")
    table = load_specs(specs, ["event_name"], **options)
    rows = [(i, "x", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(props)]
    events = spark.createDataFrame(rows, "id int, event_name string, props string")
    results = property_results(
        add_results(lookup_spec(open_levels(events, "props"), table), patterns=table.patterns), ["id"]
    ).collect()
    out = [{} for _ in props]
    for r in results:
        name = r["property"] + (f".{r['child']}" if r["child"] else "")
        if r["failed"] is not None:
            out[r["id"]][name] = ("failed", r["failed"])
        if r["passed"] is not None:
            out[r["id"]][name] = ("passed", r["passed"])
    return out


def test_pinned_and_two_pins(spark):
    spec = {"m": prop(p={"email": ["e"], "phone": ["v1"]})}
    assert check(spark, spec, {"m": "email"}, {"m": "x"}, {"other": 1}) == [
        {"m": ("failed", ["v1"])}, {"m": ("passed", ["v2"])}, {}
    ]


def test_value_forms(spark):
    spec = {"m": prop(p={"1": ["e"], "true": ["v1"], "null": ["v2"]})}
    out = check(spark, spec, '{"m":1.0}', '{"m":"1"}', {"m": True}, {"m": None}, ids=IDS + ["w1", "w2", "w3"])
    assert [o["m"][1] for o in out] == [["v1", "v2"], ["v1", "v2"], ["e", "v2"], ["e", "v1"]]


def test_optional_null_and_required(spark):
    spec = {"a": prop(required=False, p={"x": ["e"]}), "b": prop(required=True, p={"x": ["e"]})}
    assert check(spark, spec, {"a": None, "b": None}) == [{"b": ("failed", ["e"])}]


def test_allowed(spark):
    spec = {"a": prop(v={'["x","5"]': ["e"], "[]": ["v1"], "bad json": ["v2"], '{"x":1}': ["v2"]})}
    assert check(spark, spec, {"a": "x"}, {"a": 5}, {"a": "y"}, ids=IDS + ["w"]) == [
        {"a": ("failed", ["v1"])}, {"a": ("failed", ["v1"])}, {"a": ("failed", ["e", "v1"])}
    ]


def test_regex(spark):
    spec = {"a": prop(rx={"^a.c$": ["e"], "(a+)+$": ["v1"], "[bad(": ["v2"]})}
    out = check(spark, spec, {"a": "abc"}, {"a": "abc\n"}, {"a": "x" * 20000}, {"a": 5}, {"a": None}, ids=IDS + ["w", "x", "y"])
    assert out == [{}, {"a": ("failed", ["e"])}, {"a": ("failed", ["e"])}, {"a": ("failed", IDS)}, {"a": ("failed", IDS)}]


@pytest.mark.parametrize(
    "pattern, safe",
    [
        ("^[a-z]+@[a-z]+\\.com$", True), ("(a+)+$", False), ("^[0-9]{5}(-[0-9]{4})?$", False), ("(ab|c+)*", False), ("a*" * 25, True),
        ("a*" * 26, False), ("a+?b", True), ("[*+]+", True), ("(a", False), ("\\(a+\\)+", True), ("((a)+b)*", False),
    ],
)
def test_pattern_gate(pattern, safe):
    assert is_safe(pattern) == safe


def test_pattern_translation():
    assert to_java("a$") == r"a\z" and to_java(r"\$[$]") == r"\$[$]" and to_java("[^]") == r"[\s\S]" and to_java("[a[]") == r"[a\[]"


def test_min_max(spark):
    spec = {"a": prop(minmax={"0,10": ["e"], "5,": ["v1"], ",7": ["v2"], "x,1": ["w"], "3abc,100": ["w2"]})}
    ids = IDS + ["w", "w2", "y", "z"]
    out = check(spark, spec, {"a": 10}, {"a": 2}, {"a": 10.5}, {"a": "5"}, ids=ids)
    assert [o["a"] for o in out] == [
        ("failed", ["v2"]), ("failed", ["v1", "w2"]), ("failed", ["e", "v2"]), ("passed", ["y", "z"])
    ]


def test_list_of_scalars(spark):
    spec = {"l": prop(is_list=True, v={'["a","b"]': ["e"]}, p={"a": ["v1"]})}
    assert check(spark, spec, {"l": ["a"]}, {"l": ["a", "b"]}, {"l": [None]}, {"l": []}, {"l": "a"}, ids=IDS + ["w"]) == [
        {}, {"l": ("failed", ["v1"])}, {"l": ("failed", ["v1", "e"])}, {}, {}
    ]


def test_object_children_and_depth(spark):
    deep = prop(children={"x": prop(p={"never": ["e"]})})
    spec = {"o": prop(children={"a": prop(p={"1": ["e"]}), "b": prop(required=False, p={"1": ["v1"]}), "c": deep,
                                "d": prop(is_list=True, required=False, minmax={"0,5": ["v2"]})})}
    assert check(spark, spec, {"o": {"a": 1, "b": 2, "c": {"x": 0}, "d": [1, 9]}}, {"o": None}, {"o": [1]}) == [
        {"o.b": ("failed", ["v1"]), "o.d": ("failed", ["v2"])}, {"o.a": ("failed", ["e"])}, {"o.a": ("failed", ["e"])}
    ]


def test_list_of_objects(spark):
    spec = {"l": prop(is_list=True, children={"q": prop(minmax={"1,3": ["v1"], "0,9": ["e"]}), "n": prop(required=False, p={"x": ["e"]})})}
    assert check(spark, spec, {"l": [{"q": 1}, {"q": 20}]}, {"l": [{"q": 2, "n": "y"}, 5]}, {"l": []}, {"l": {}}) == [
        {"l.q": ("passed", ["v2"])}, {"l.q": ("passed", ["v2"]), "l.n": ("failed", ["e"])}, {}, {}
    ]


def test_items_that_break_the_same_checks(spark):
    """Of equal outcomes one stands for all; the order of the ids is that of the first items."""
    spec = {"l": prop(is_list=True, children={
        "q": prop(minmax={"1,3": ["v2"], "0,9": ["v1"]}), "t": prop(v={'["a","a","b"]': ["e"], "[]": ["v1"]}), "o": prop(required=False, p={"x": ["e"]}),
        "k": prop(p={"1.5": ["v1"]}, rx={"^1": ["e"]}), "m": prop(minmax={"0,1e3": ["v1"]}, p={"null": ["e"]})})}
    items = [{"q": 2, "t": "a", "k": 1.5, "m": None}, {"q": 5, "t": "a", "o": None, "k": "1.5", "m": 1}] * 20 + [{"q": 50, "t": "b", "o": "x", "k": "1", "m": "0"}, 7]
    assert check(spark, spec, {"l": items}, {"l": items[:2]}, ids=IDS + ["w", "x", "y"]) == [
        {"l.q": ("failed", ["v2", "v1"]), "l.t": ("failed", ["v1", "e"]), "l.k": ("failed", ["e", "v1"]), "l.m": ("failed", ["v1", "e"])},
        {"l.q": ("failed", ["v2"]), "l.t": ("failed", ["v1"]), "l.k": ("failed", ["e"]), "l.m": ("failed", ["v1", "e"])},
    ]


def test_ranges_cost_one_pass_over_items(spark):
    """The checks of a rule were looked through for other kinds than ranges at every value."""
    specs = spark.createDataFrame([("x", wire({"a": prop(minmax={"0,5": ["e"]}), "b": prop(p={"1": ["e"]}, minmax={"0,5": ["e"]})}))], "event_name string, spec_json string")
    plan = load_specs(specs, ["event_name"]).df.first()["plan"]
    assert plan["a"]["only_ranges"] and not plan["b"]["only_ranges"]


def two_entries(second_required=False):
    entries = [
        {"b": "m", "id": "e1", "vids": [], "p": {"m": prop(p={"a": ["e1"]}), "l": prop(is_list=True, p={"x": ["e1"]})}},
        {"b": "m", "id": "e2", "vids": ["e2.v"], "p": {"m": prop(required=second_required, p={"a": ["e2"], "b": ["e2.v"]})}},
    ]
    return json.dumps({"events": entries, "metadata": {"schemaId": "s", "branchId": "b", "latestActionId": "a"}})


def test_name_mapped_entries(spark):
    assert check(spark, {}, {"m": "b"}, {"m": None}, document=two_entries()) == [
        {"m": ("passed", ["e2.v"])}, {"m": ("failed", ["e1", "e2", "e2.v"])}
    ]
    # a merged specification loses its list flag, and the list is compared as text
    assert check(spark, {}, {"l": ["x"]}, document=two_entries()) == [{"l": ("failed", ["e1"])}]
    assert check(spark, {}, {"l": ["x"]}, document=two_entries(), keep_is_list=True) == [{}]


def test_repeated_ids_shift_the_choice(spark):
    spec = {"k": prop(p={"1": ["e", "v1"]})}
    assert check(spark, spec, {"k": 2}, ids=["e", "v1", "w"]) == [{"k": ("passed", ["w"])}]
    assert check(spark, spec, {"k": 2}, ids=["e", "v1", "w", "w"]) == [{"k": ("failed", ["e", "v1"])}]


def test_nested_value_against_scalar_rule(spark):
    spec = {"k": prop(p={'[1,2.5,{"a":1}]': ["e"]})}
    assert check(spark, spec, '{"k":[1.0, 2.50, {"a": 1}]}', '{"k":[1,2.5]}') == [{}, {"k": ("failed", ["e"])}]


def test_bad_shape_is_no_spec(spark):
    specs = spark.createDataFrame([("x", '{"events":[],"metadata":{}}')], "event_name string, spec_json string")
    events = spark.createDataFrame([("x", "{}")], "event_name string, props string")
    assert lookup_spec(events, load_specs(specs, ["event_name"])).filter(F.col("plan").isNotNull()).count() == 0
    empty = wire({}).replace(wire({})[wire({}).index("[") : wire({}).rindex("]") + 1], "[]", 1)
    known = spark.createDataFrame([("x", empty)], "event_name string, spec_json string")
    assert lookup_spec(events, load_specs(known, ["event_name"])).filter(F.col("plan").isNotNull()).count() == 1


def test_large_table_joins_by_shuffle(spark, monkeypatch):
    spec = {"a": prop(rx={"^a.c$": ["e"], "(a+)+$": ["v1"]}), "k": prop(minmax={"0,5": ["v1"]})}
    rows = ({"a": "abc", "k": 9}, {"a": "b"}, {"a": 5})
    small = check(spark, spec, *rows, ids=IDS + ["w"])
    monkeypatch.setattr("plumbline.sources.specs.BROADCAST_BYTES", -1)
    specs = spark.createDataFrame([("x", wire(spec))], "event_name string, spec_json string")
    table = load_specs(specs, ["event_name"])
    assert not table.small and table.patterns == []
    plan = lookup_spec(spark.createDataFrame([("x", "{}")], "event_name string, props string"), table)
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()
    assert check(spark, spec, *rows, ids=IDS + ["w"]) == small
    assert small[0] == {"k": ("failed", ["v1"])} and small[1] == {"a": ("failed", ["e"])}


def test_validation_does_not_shuffle(spark):
    specs = spark.createDataFrame([("x", wire({"k": prop(minmax={"0,5": ["e"]})}))], "event_name string, spec_json string")
    table = load_specs(specs, ["event_name"])
    events = spark.createDataFrame([("x", '{"k":1}')], "event_name string, props string")
    checked = add_results(lookup_spec(open_levels(events, "props"), table), patterns=table.patterns)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
