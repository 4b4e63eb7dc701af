import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from models import as_float, is_json as valid
from opsframe.functions import (
    base64_json,
    encode_base64,
    flatten_lists,
    float_or_null,
    infer_json_schema,
    is_json,
    nested_to_string,
    numeric_hook,
    parse_json_line,
    parse_json_numeric,
)
from opsframe.sources import parse_lines

LINES = [
    '{"a":1}',
    ' {"a": 1} ',
    '{"a":1,"a":2}',
    "3",
    '"x"',
    "null",
    "true",
    "-0.5e3",
    "[]",
    '[{"a":1},2]',
    "",
    "   ",
    "{bad",
    "{'a':1}",
    '{"a":01}',
    '{"a":1} x',
    '{"a":1}{"b":2}',
    "1,2",
    "1],[2",
    '1,"v":2',
    '1},{"v":2',
    "1]",
    "1}",
    "[1",
    '{"a":NaN}',
    '{"a":[-Infinity,Infinity]}',
    '{"a":"NaN"}',
    '{"a":"x, NaN, y"}',
    "NaN",
    "NaNa",
    '{"a":"NaN}',
    '{"a":"x\ty"}',
    '{"a":\t1}',
    '{"a":"\\u00e9\\n"}',
    '{"a":1e400}',
    '{"a":123456789012345678901234567890}',
    '{"a":nul}',
    "tru",
    '{"":{"":[]}}',
    "{,}",
    "[1,]",
    "// x",
    "1 // x",
    '{"a":+1}',
    '{"a":.5}',
    '{"a":"\\x"}',
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_json_lines_are_those_python_reads(spark):
    got = {
        r.value: r.ok
        for r in lines(spark, LINES).withColumn("ok", is_json("value")).collect()
    }
    assert got == {line: valid(line) for line in LINES}


def test_parsed_values_equal_python(spark):
    good = [x for x in LINES if valid(x) and "NaN" not in x]
    good = [x for x in good if "Inf" not in x and "e400" not in x]
    rows = lines(spark, good).select(
        "value", F.to_json(parse_json_line("value")).alias("json")
    )
    for row in rows.collect():
        assert json.loads(row.json) == json.loads(row.value)


def test_two_lines_with_different_keys(spark):
    df = parse_lines(
        lines(spark, ['{"a":"b"}', '{"c":"d"}', "oops"]), "a string, c string"
    )
    assert sorted(map(tuple, df.collect()), key=str) == [
        ("b", None),
        (None, "d"),
    ]


def test_scalar_lines_stay_as_rows(spark):
    df = parse_lines(lines(spark, ["3", "null", '{"a":1}', "x"]), "a int")
    assert sorted(r.a or 0 for r in df.collect()) == [0, 0, 1]


def test_nested_objects_become_text(spark):
    df = spark.createDataFrame([("b", 1, (5,))], "a string, c long, d struct<e:long>")
    assert nested_to_string(df).collect() == [("b", 1, '{"e":5}')]


def test_floats_and_missing_values_become_text(spark):
    df = spark.createDataFrame(
        [(1.5, None, True, [None, 1], datetime(2024, 1, 2, 3, 4, 5, 678901))],
        "f double, g double, b boolean, l array<int>, t timestamp_ntz",
    )
    row = nested_to_string(df).first()
    assert row[:4] == ("1.5", "null", True, "[null,1]")
    assert row.t == '"2024-01-02T03:04:05.678901"'


def test_numeric_string_becomes_a_number(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert numeric_hook(df).first().asDict() == {"a": "1", "a_num": 1.0}


def test_numeric_hook_types(spark):
    df = spark.createDataFrame(
        [(7, True, [1], None)], "i int, b boolean, l array<int>, s string"
    )
    assert numeric_hook(df).first().asDict() == {
        "i": 7.0,
        "b": 1.0,
        "l": [1],
        "s": None,
        "s_num": None,
    }


NUMBERS = [
    "1", " 1 ", "1.", ".5", "-.5e-3", "1e5", "1E+5", "1_000", "1__0", "_1",
    "1_", "1_.5", "1._5", "1_0.0_1", "1d", "1f", "0x10", "inf", "-Infinity",
    "+inf", "nan", "+nan", "-NaN", "infinit", "", " ", "abc", "1 2", "\t3\n",
    " 4 ", "--1", "1e", "e5", ".", "1e1_0", "true", "9" * 400,
]


def test_float_reading_equals_python(spark):
    rows = lines(spark, NUMBERS).withColumn("n", float_or_null("value"))
    for row in rows.collect():
        wanted = as_float(row.value)
        if wanted is not None and math.isnan(wanted):
            assert math.isnan(row.n)
        else:
            assert row.n == wanted, row.value


def test_parse_json_numeric_nested(spark):
    raw = json.dumps({"a": "b", "c": 1, "d": {"e": 5, "f": "2.5"}, "l": ["1", 2]})
    df = lines(spark, [raw, "bad"])
    schema = "a string, c int, d struct<e:int,f:string>, l array<string>"
    good, bad = (
        parse_json_numeric(df, "value", schema).orderBy(F.desc("value")).collect()
    )
    assert good.parsed.asDict(recursive=True) == {
        "a": "b",
        "a_num": None,
        "c": 1.0,
        "d": {"e": 5.0, "f": "2.5", "f_num": 2.5},
        "l": ["1", "2"],
    }
    assert bad.value == "bad" and bad.parsed is None
    assert parse_json_numeric(df, "value", schema, drop_bad=True).count() == 1


def test_inferred_schema_covers_all_rows(spark):
    df = lines(
        spark,
        ['{"a":1,"m":1}', '{"b":{"c":["x"]},"m":"7"}', '{"n":null}', "bad"],
    )
    parsed = parse_json_numeric(df, "value", drop_bad=True)
    rows = [r.parsed.asDict(recursive=True) for r in parsed.collect()]
    assert {r["a"] for r in rows} == {1.0, None}
    assert {r["m_num"] for r in rows} == {1.0, 7.0, None}
    assert [r["b"] for r in rows if r["b"]] == [{"c": ["x"]}]
    assert "VARIANT" not in parsed.schema.simpleString().upper()
    assert "struct" in infer_json_schema(df, "value").simpleString()


def test_last_of_repeated_keys_wins(spark):
    df = lines(spark, ['{"a":1,"a":2}'])
    assert parse_json_numeric(df, "value", "a int").first().parsed.a == 2.0


def test_base64_round_trip(spark):
    text = json.dumps({"k": "é" * 100})
    df = lines(spark, [text]).withColumn("e", encode_base64("value"))
    row = df.withColumn("d", base64_json("e", "k string")).first()
    assert row.d.k == "é" * 100
    assert "\n" not in row.e


def test_bad_context_fails_when_strict(spark):
    df = lines(spark, ["{oops"]).select(encode_base64("value").alias("e"))
    assert df.select(base64_json("e", "k int", strict=False).alias("d")).first().d in (
        None,
        (None,),
    )
    with pytest.raises(Exception):
        df.select(base64_json("e", "k int")).collect()


def test_flatten_skips_missing_sublists(spark):
    df = spark.createDataFrame(
        [([[1, 2], None, [], [3]],), ([],), (None,)], "l array<array<int>>"
    )
    got = [r[0] for r in df.select(flatten_lists("l")).collect()]
    assert got == [[1, 2, 3], [], None]


def test_inferred_schema_keeps_odd_keys(spark):
    text = '{"a b":1,"OBJECT<x":{"c":null,"d`e":[1,2.5]},"VOID":2,"e":{},"":5}'
    df = spark.createDataFrame([(text,), ("broken",)], "v string")
    row = parse_json_numeric(df, "v").filter("parsed IS NOT NULL").first().parsed
    assert row["a b"] == 1.0 and row["VOID"] == 2.0 and row[""] == 5.0
    assert row["OBJECT<x"]["d`e"] == [1, 2.5] and row["OBJECT<x"]["c"] is None


def test_only_bad_rows_give_nulls_and_are_counted(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("{",), (None,), ("x y",)], "v string")
    seen = Observation("parsed")
    rows = parse_json_numeric(df, "v", observation=seen).collect()
    assert [r.parsed for r in rows] == [None] * 3
    assert seen.get == {"bad_rows": 2}
    seen = Observation("again")
    parse_json_numeric(df, "v", "a double", drop_bad=True, observation=seen).collect()
    assert seen.get == {"bad_rows": 2}
