import json
import random

import pytest
from pyspark.sql import functions as F

from models import leaves, random_record, search
from opsframe.operators import find_paths, leaf_paths, node_map, nodes
from opsframe.operators.nested import variant_depth

EXAMPLE = {"a": 1, "b": {"c": 2, "d": 3, "e": {"f": 4}}}
TYPED = (
    "a bigint, s string, b struct<c:bigint,e:struct<f:boolean>>,"
    " l array<string>, o array<struct<x:bigint,y:array<bigint>>>,"
    " n array<array<bigint>>"
)


@pytest.fixture(scope="module")
def records():
    rng = random.Random(7)
    return [random_record(rng) for _ in range(400)]


def variants(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, text string").select(
        "id", F.parse_json("text").alias("record")
    )


def by_id(rows, size):
    out = [[] for _ in range(size)]
    for row in rows:
        out[row.id].append((row.path, row.value))
    return [sorted(part) for part in out]


def normal(pairs):
    return sorted((p, json.dumps(json.loads(v), sort_keys=True)) for p, v in pairs)


def in_any_order(values):
    return sorted(json.dumps(value, sort_keys=True) for value in values)


@pytest.mark.parametrize("lists", ["whole", "element", "leaf"])
def test_random_records(spark, records, lists):
    rows = node_map(variants(spark, records), "record", lists=lists).collect()
    got = by_id(rows, len(records))
    for record, pairs in zip(records, got):
        assert normal(pairs) == normal(leaves(record, lists))


def test_random_leaf_paths(spark, records):
    rows = leaf_paths(variants(spark, records), "record").collect()
    for row in rows:
        wanted = [p for p, _ in leaves(records[row.id], "leaf")]
        assert sorted(row.paths) == sorted(wanted)


def test_random_finds(spark, records):
    paths = ["a", "a.b", "b", "name.c", "c"]
    found = find_paths(variants(spark, records), "record", paths)
    for row in found.collect():
        wanted = search(records[row.id], paths)
        for path in paths:
            got = row[path.replace(".", "_")]
            got = None if got is None else json.loads(got)
            if isinstance(got, list) and isinstance(wanted[path], list):
                assert in_any_order(got) == in_any_order(wanted[path])
            elif path not in row.missing:
                assert got == wanted[path]
        absent = [p for p in paths if p not in dict(leaves(records[row.id]))]
        assert sorted(row.missing) == sorted(absent)


def test_documented_example(spark):
    rows = node_map(variants(spark, [EXAMPLE]), "record").collect()
    assert sorted((r.path, r.value) for r in rows) == [
        ("a", "1"),
        ("b.c", "2"),
        ("b.d", "3"),
        ("b.e.f", "4"),
    ]


def typed_records():
    rng = random.Random(11)

    def maybe(value):
        return None if rng.random() < 0.25 else value

    def numbers():
        return [rng.choice([None, 1, 2]) for _ in range(rng.randrange(3))]

    def item():
        return maybe({"x": maybe(rng.randrange(9)), "y": maybe(numbers())})

    return [
        {
            "a": maybe(rng.randrange(9)),
            "s": maybe(rng.choice(["", "x", 'q"\n', "é"])),
            "b": maybe({"c": maybe(1), "e": maybe({"f": maybe(True)})}),
            "l": maybe([maybe("t") for _ in range(rng.randrange(4))]),
            "o": maybe([item() for _ in range(rng.randrange(4))]),
            "n": maybe([maybe(numbers()) for _ in range(rng.randrange(3))]),
        }
        for _ in range(200)
    ]


def without_nulls(value):
    """A dict without its null entries, as a typed record cannot tell them
    from absent ones. Nulls in lists are kept."""
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    if isinstance(value, list):
        return [without_nulls(v) if isinstance(v, dict) else v for v in value]
    return value


def typed(spark, values):
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, text string").select(
        "id", F.from_json("text", TYPED).alias("record")
    )


@pytest.mark.parametrize("lists", ["whole", "element", "leaf"])
@pytest.mark.parametrize("nulls", ["drop", "emit"])
def test_typed_records(spark, lists, nulls):
    values = typed_records()
    rows = node_map(
        typed(spark, values), "record", lists=lists, nulls=nulls
    ).collect()
    got = by_id(rows, len(values))
    for value, pairs in zip(values, got):
        shown = value if nulls == "emit" else without_nulls(value)
        wanted = leaves(shown, lists)
        if lists != "whole" and lists != "leaf":
            assert normal(pairs) == normal(wanted)
            continue
        # Dropped nulls still show inside lists that are printed as a whole.
        assert [p for p, _ in sorted(pairs)] == [p for p, _ in wanted]


def test_typed_finds_and_paths(spark):
    values = typed_records()
    paths = ["a", "b.c", "b.e.f", "l", "o.x", "o.y", "n", "o", "nowhere"]
    df = typed(spark, values)
    for row in find_paths(df, "record", paths).collect():
        held = without_nulls(values[row.id])
        present = {p for p, _ in leaves(held)}
        assert set(row.missing) == {p for p in paths if p not in present}
        wanted = search(held, ["a", "b.c", "b.e.f", "o.x"])
        for path, value in wanted.items():
            got = row[path.replace(".", "_")]
            got = None if got is None else json.loads(got)
            if isinstance(got, list):
                assert sorted(got) == sorted(value)
            else:
                assert got == value
    for row in leaf_paths(df, "record").collect():
        held = without_nulls(values[row.id])
        assert sorted(row.paths) == sorted({p for p, _ in leaves(held, "leaf")})


def test_map_keys_are_path_parts(spark):
    df = spark.createDataFrame(
        [(1, {"k": {"p": 1, "q": 2}, "m": {}}), (2, None)],
        "id int, record map<string,map<string,int>>",
    )
    rows = node_map(df, "record").collect()
    assert sorted((r.path, r.value) for r in rows) == [("k.p", "1"), ("k.q", "2")]
    found = find_paths(df, "record", ["k.q", "k.z"]).orderBy("id").collect()
    assert [(r.k_q, r.missing) for r in found] == [
        ("2", ["k.z"]),
        (None, ["k.q", "k.z"]),
    ]
    assert df.select(F.size(nodes(df, "record"))).first()[0] == 2


def test_several_values_keep_the_order_of_the_record(spark):
    record = {"o": [{"x": 3}, {"x": 1}, {"y": 0}, {"x": 2}]}
    for df in (variants(spark, [record]), typed(spark, [record])):
        row = find_paths(df, "record", ["o.x"]).first()
        assert row.o_x == "[3,1,2]"


def test_missing_path_fails_when_strict(spark):
    df = variants(spark, [EXAMPLE])
    assert find_paths(df, "record", ["a"], strict=True).first().a == "1"
    with pytest.raises(Exception, match="b.x"):
        find_paths(df, "record", ["a", "b.x"], strict=True).collect()


def test_paths_given_as_text_are_refused(spark):
    with pytest.raises(TypeError):
        find_paths(variants(spark, [EXAMPLE]), "record", "a")


def test_too_deep_a_record_fails(spark):
    deep = {"a": {"a": {"a": 1}}}
    df = variants(spark, [deep])
    assert node_map(df, "record", max_depth=3).count() == 1
    with pytest.raises(Exception, match="max_depth"):
        node_map(df, "record", max_depth=2).collect()


def test_depth_counts_dicts_also_inside_lists(spark):
    for record, depth in (
        ({"a": [[{"x": 1}]]}, 1),
        ({"a": [{"b": [1, 2]}]}, 2),
        ({"a": [{"b": [{"c": []}, {"c": [0]}]}]}, 3),
        ({"a": {"b": {}}}, 2),
    ):
        df = variants(spark, [record])
        got = node_map(df, "record", max_depth=depth).collect()
        assert normal([(r.path, r.value) for r in got]) == normal(leaves(record))
        if depth > 1 and leaves(record):
            with pytest.raises(Exception, match="max_depth"):
                node_map(df, "record", max_depth=depth - 1).collect()


def test_nothing_is_shuffled(spark, plan_of):
    df = typed(spark, typed_records())
    for query in (
        node_map(df, "record"),
        find_paths(df, "record", ["o.x"]),
        node_map(variants(spark, [EXAMPLE]), "record"),
    ):
        assert "Exchange" not in plan_of(query)


def test_find_reads_only_the_wanted_fields(spark, tmp_path, plan_of):
    path = str(tmp_path / "typed")
    typed(spark, typed_records()).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_of(find_paths(df, "record", ["b.c"]).select("b_c"))
    assert "ReadSchema: struct<record:struct<b:struct<c:bigint>>>" in plan


def test_records_of_any_depth(spark):
    import json

    record = leaf = {}
    for k in range(30):
        leaf["k"] = {} if k < 29 else 7
        leaf["s"] = '}{"[\\\\'
        leaf = leaf["k"]
    df = spark.createDataFrame([(json.dumps(record),)], "t string").select(
        F.parse_json("t").alias("r")
    )
    found = {r.path: r.value for r in node_map(df, "r").collect()}
    assert found[".".join(["k"] * 30)] == "7" and len(found) == 31
    assert len(leaf_paths(df, "r").first().paths) == 31
    row = find_paths(df, "r", [".".join(["k"] * 30)], ["deep"]).first()
    assert row.deep == "7"


@pytest.mark.parametrize("lists", ["whole", "element", "leaf"])
def test_long_strings_without_max_depth(spark, lists):
    long = 'a"\\\\' * 250_000 + "]}" * 1000
    record = {"s": long, "t": {"u": [long, {"v": long}], "w": []}, "x": "\\"}
    df = variants(spark, [record, {"a": [[long]]}])
    rows = node_map(df, "record", lists=lists).collect()
    got = by_id(rows, 2)
    assert normal(got[0]) == normal(leaves(record, lists))
    assert normal(got[1]) == normal(leaves({"a": [[long]]}, lists))
    paths = leaf_paths(df, "record").orderBy("id").collect()
    assert sorted(paths[0].paths) == sorted(p for p, _ in leaves(record, "leaf"))
    found = find_paths(df, "record", ["t.u.v", "x"]).orderBy("id").first()
    assert json.loads(found.t_u_v) == long and json.loads(found.x) == "\\"


def test_depth_of_escaped_quotes(spark):
    from opsframe.operators.nested import variant_depth

    record = {"a": {"b": ['\\"{[' * 100_000, {"c": "\\\\"}]}}
    assert variant_depth(variants(spark, [record]), "record") == 4


def test_variant_walk_is_one_stage(spark, plan_of):
    plan = plan_of(node_map(variants(spark, [EXAMPLE]), "record"))
    assert "Generate" in plan and "Exchange" not in plan
    assert "lambdafunction" not in plan.lower()


def test_variant_walk_makes_json_text_once_per_level(spark):
    # The text was made again for each column and for the filter: one CASE
    # with the paths, one with the open values, one with the texts.
    df = spark.sql("""SELECT 1 AS id, parse_json('{"a":{"b":"x]"}}') AS record""")
    found = node_map(df, "record", ["id"], max_depth=2)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("to_json(") <= 16
    assert [(r.path, r.value) for r in found.collect()] == [("a.b", '"x]"')]


def test_variant_depth_of_escaped_and_quoted_brackets(spark):
    records = [{"a\\": [{"b": "}]{"}]}, {'"{[[[[': 1}, {"c": "\n\"{[[[["}]
    assert variant_depth(variants(spark, records), "record") == 3
