"""Types, documents and rows of property objects."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions.documents import add_schema_document, open_levels
from plumbline.functions.values import number_text, number_type, value_text
from plumbline.operators.dedup import params_fingerprint, schema_fingerprint
from plumbline.operators.extract import extract_document, extract_schema, sealer, unseal
from plumbline.sources.events import accept_events, read_events, read_schemas, split_rejects


def documents(spark, *raws, **options):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, props string")
    rows = extract_document(df, **options).orderBy("id").collect()
    return [json.loads(r["document"]) for r in rows]


def leaf(name, kind, **more):
    return {"propertyName": name, "propertyType": kind, **more}


@pytest.mark.parametrize(
    "number, kind, text",
    [
        ("0", "int", "0"), ("1.0", "int", "1"), ("-2.50", "float", "-2.5"), ("1e21", "int", "1e+21"), ("1e20", "int", "1" + "0" * 20),
        ("1e-7", "int", "1e-7"), ("1.5e300", "float", "1.5e+300"), ("0.000001", "float", "0.000001"), ("12345678.9", "float", "12345678.9"),
        ("1e-6", "float", "0.000001"), ("0.00012", "float", "0.00012"), ("123456789012345680000", "int", "123456789012345680000"),
    ],
)
def test_numbers(spark, number, kind, text):
    row = spark.range(1).select(F.expr(f"CAST('{number}' AS double)").alias("d"))
    assert tuple(row.select(F.expr(number_type("d")), F.expr(number_text("d"))).first()) == (kind, text)


def test_all_types(spark):
    raw = (
        '{"rented":true,"minutes":42,"station":"Harbour","fee":2.75,"voucher":null,"rider":{"plan":"day"},'
        '"stops":[{"dock":3},"pier",[8,9],7,["east","west"],1.25]}'
    )
    kids = [[leaf("dock", "int")], "string", ["int"], "int", ["string"], "float"]
    assert documents(spark, raw) == [
        [
            leaf("rented", "boolean"), leaf("minutes", "int"), leaf("station", "string"), leaf("fee", "float"), leaf("voucher", "null"),
            leaf("rider", "object", children=[leaf("plan", "string")]), leaf("stops", "list", children=kids),
        ]
    ]


def test_repeats_falsy_and_items(spark):
    repeated, falsy, items, absent = documents(
        spark,
        '{"codes":[4,"no",2.5,"no",false,"yes",4,5,false,2.5,"no"]}',
        '{"note":"","zero":0.0,"off":false,"gap":null,"count":0,"bag":[],"box":{},"gaps":[null,null]}',
        '{"legs":[{"open":false,"km":12,"to":"mill"}]}',
        None,
    )
    assert repeated == [leaf("codes", "list", children=["int", "string", "float", "boolean"])]
    assert [p["propertyType"] for p in falsy] == ["string", "int", "boolean", "null", "int", "list", "object", "list"]
    assert falsy[7]["children"] == [[], []]
    assert items == [leaf("legs", "list", children=[[leaf("open", "boolean"), leaf("km", "int"), leaf("to", "string")]])]
    assert absent == []


def test_key_order_and_duplicates(spark):
    (document,) = documents(spark, '{"b":1,"10":1,"a":1,"9":1,"b":"last"}')
    assert [(p["propertyName"], p["propertyType"]) for p in document] == [("9", "int"), ("10", "int"), ("b", "string"), ("a", "int")]


def test_depth_has_no_limit(spark):
    raw = value = '{"x":[1.5,{"y":null,"2":1,"1":"s"}]}'
    for _ in range(9):
        raw = f'{{"n":{raw},"l":[[{raw}],1.0]}}' if len(raw) < 2000 else f'{{"n":{raw}}}'
    shallow = spark.createDataFrame([(raw,)], "props string")
    texts = {
        add_schema_document(open_levels(shallow, "props", max_depth=d), "document", max_depth=d).first()["document"] for d in (1, 3, 5)
    }
    assert len(texts) == 1 and "\u0001" not in texts.pop()
    rows = [
        {(tuple(r["path"]), r["type"]) for r in extract_schema(shallow, [], max_depth=d).collect()} for d in (1, 4)
    ]
    assert rows[0] == rows[1] and max(len(p) for p, _ in rows[0]) > 9


def test_value_text_of_nested(spark):
    raw = r'{"o": {"z": 1.0, "y\"1.0": [2.50, "x1.0,\\", {"q":1e21}, "7E5", 1e-7, 12345678.9, 1e20, 3.0E2]}}'
    df = open_levels(spark.createDataFrame([(raw,)], "props string"), "props", max_depth=1)
    expected = r'{"z":1,"y\"1.0":[2.5,"x1.0,\\",{"q":1e+21},"7E5",1e-7,12345678.9,100000000000000000000,300]}'
    assert df.select(F.expr(value_text("get(_level0, 0)"))).first()[0] == expected


def test_sealed_values(spark):
    key = "0123456789abcdef"
    (document,) = documents(spark, '{"a":"x","l":[1],"o":{"b":2}}', seal=sealer(key, "dev"))
    assert "encryptedPropertyValue" not in document[1] and "encryptedPropertyValue" not in document[2]
    sealed = [document[0]["encryptedPropertyValue"], document[2]["children"][0]["encryptedPropertyValue"], "broken"]
    opened = spark.createDataFrame([(s,) for s in sealed], "s string").select(unseal(F.col("s"), key)).collect()
    assert [r[0] for r in opened] == ['"x"', "2", None]
    assert sealer(key, "prod") is None and sealer("", "dev") is None
    with pytest.raises(ValueError):
        sealer("short", "dev")


def test_sealed_values_below_the_opened_levels(spark):
    key = "0123456789abcdef"
    raw = '{"a":{"b":{"c":{"d":{"e":{"f":"deep","g":{"h":-2.50,"i":null,"j":[{"k":true,"l":[1]}],"m":"\\"q\\" ü"}}}}}}}'
    (document,) = documents(spark, raw, seal=sealer(key, "dev"))
    found = {}

    def walk(members):
        for m in members:
            if isinstance(m, list):
                walk(m)
            elif isinstance(m, dict):
                if "children" in m:
                    assert "encryptedPropertyValue" not in m
                    walk(m["children"])
                else:
                    found[m["propertyName"]] = m["encryptedPropertyValue"]

    walk(document)
    opened = spark.createDataFrame(list(found.items()), "name string, s string").select("name", unseal(F.col("s"), key).alias("o"))
    assert dict(map(tuple, opened.collect())) == {"f": '"deep"', "h": "-2.5", "i": "null", "k": "true", "m": '"\\"q\\" ü"'}


def test_fingerprints(spark):
    raws = ['{"lap":"third","split":[31,28],"sky":{"wet":[false]}}', '{"sky":{"wet":[false]},"split":[31.0,28], "lap":"third"}', '{"lap":"third","split":[28,31],"sky":{"wet":[false]}}']
    df = spark.createDataFrame([(r,) for r in raws], "props string")
    same, other, different = (r[0] for r in df.select(params_fingerprint(F.col("props"))).collect())
    assert same == other != different
    docs = spark.createDataFrame([('[{"p":1},{"q":2}]',), ('[{"q":2},{"p":1}]',)], "d string")
    assert docs.select(schema_fingerprint(F.col("d"))).distinct().count() == 2
    assert docs.select(schema_fingerprint(F.col("d"), ordered=False)).distinct().count() == 1


def test_rejects_and_sources(spark, tmp_path):
    texts = {'{"a":1}': True, "[1]": False, "bad": False, None: True, '"s"': False, ' {"a":[{}]} \n': True, "": False}
    behind = [" oops", "}", "]", ',{"b":2}', ',"y":1', "}} {", "]] [", "},{", "],[", " null"]
    texts |= {'{"a":1}' + more: False for more in behind}
    df = spark.createDataFrame([(r,) for r in texts], "props string").coalesce(1)
    assert {r["props"]: r["accepted"] for r in accept_events(df).collect()} == texts
    good, bad = split_rejects(df)
    assert (good.count(), bad.count()) == (3, len(texts) - 3)
    spark.createDataFrame([("u", "{}")], "uid string, props string").write.parquet(str(tmp_path / "e"))
    assert read_events(spark, str(tmp_path / "e")).first()["uid"] == "u"
    schemas = spark.createDataFrame([('[{"propertyName":"a","propertyType":"list","children":["int"]}]',)], "schema_json string")
    assert read_schemas(schemas).select("schema.propertyName").first()[0] == ["a"]


def test_the_plan_does_not_show_the_key(spark):
    key = "0123456789abcdef"
    df = extract_document(spark.createDataFrame([('{"a":"x","o":{"b":2}}',)], "props string"), seal=sealer(key, "dev"))
    assert df.columns == ["props", "document"] and df.count() == 1
    shown = df._jdf.queryExecution().toString() + repr(df.schema)
    assert "aes_encrypt" in shown and key not in shown and key.encode().hex() not in shown.lower()


ODD = [
    '{"a":{"n":[123456789012345678901234,1000000000000000000000,9223372036854775808,-1e400,1e25,2.5e-7,1.0,0.1,-0.0]}}',
    '{"a":{"10":1,"9":2,"x":3,"01":4,"4294967295":5},"b":[{"2":true,"1":null,"k":[[],{}]}]}',
    '{"a":{"tab\\\\there":{"\\\\u001f\\\\u0001":"\\\\u001e\\\\\\\\u001f"},"q\\\\"":"\\\\u00e9\\\\ud83d\\\\ude00"}}'.replace("\\\\", "\\"),
    '{"a":[1,"x",null,1.5,true,2,"y",null,[1,[2,{"z":[]}]],{"w":{}}],"b":[],"c":{}}',
    '{"a":{"d":1,"e":2,"d":"again"},"n":{"i":12345678901234567890,"j":{"k":123456789012345678901234}}}',
]


def test_helper_and_opened_levels_agree(spark):
    """The helper took every integer for one, also those that print with an exponent."""
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ODD)], "id int, props string")
    for seal in (None, lambda text: f"base64(encode({text}, 'UTF-8'))"):
        texts = [
            [r.document for r in add_schema_document(open_levels(df, "props", max_depth=d), "document", seal=seal, max_depth=d).orderBy("id").collect()]
            for d in (1, 2, 6)
        ]
        assert texts[0] == texts[2]
        assert texts[1] == texts[2]
    rows = [extract_schema(df, ["id"], max_depth=d).collect() for d in (1, 2, 6)]
    found = [sorted((r.id, tuple(r.path), r.depth, r.ord, r.name, r.type, tuple(r.list_types or ("-",))) for r in of) for of in rows]
    assert found[0] == found[2]
    assert found[1] == found[2]


def test_extraction_opens_one_level(spark, capsys):
    """Five levels of lambdas cost more than all else of an extraction."""
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":[{"d":1}]}}}')], "id int, props string")
    for found in (extract_document(df), extract_schema(df, ["id"])):
        found.explain()
        assert capsys.readouterr().out.count("_level1") == 0
    assert ["/".join(r.path) for r in extract_schema(df, ["id"]).collect()] == ["a", "a/b", "a/b/c", "a/b/c/0/d"]
