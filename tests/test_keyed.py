import pytest
from pyspark.sql import functions as F

from opsframe.operators import (
    add_members,
    associate,
    contact_lists,
    delete_all,
    delete_keys,
    list_members,
    lookup_batch,
    masked_update,
    property_updates,
    unmatched_keys,
    upsert,
)
from opsframe.operators.keyed import EDGE_COLUMNS


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def contacts(spark):
    return spark.createDataFrame(
        [(1, "a@x", "Ann", 10), (2, "b@x", "Bob", None), (3, None, "Cy", 30)],
        "vid long, email string, name string, age int",
    )


def test_lookup_by_list_and_by_table(spark, contacts):
    wanted = [(1, "Ann"), (3, "Cy")]
    keys = spark.createDataFrame([(1,), (3,), (3,), (7,), (None,)], "vid long")
    assert rows(lookup_batch(contacts, [1, 3, 7], "vid", ["name"])) == wanted
    assert rows(lookup_batch(contacts, keys, "vid", ["name"])) == wanted
    assert rows(unmatched_keys(contacts, keys, "vid")) == [(7,)]
    assert rows(unmatched_keys(contacts, [3, 8], "vid")) == [(8,)]


@pytest.mark.parametrize("n", [3, 1000, 1001, 1500])
def test_listed_keys_mean_the_same_however_many(spark, contacts, n):
    texts = [str(k) for k in range(1, n + 1)]
    found = [(1, "Ann"), (2, "Bob"), (3, "Cy")]
    assert rows(lookup_batch(contacts, texts, "vid", ["name"])) == found
    remaining, removed = delete_keys(contacts, [*texts[1:], None], "vid")
    assert [r.vid for r in remaining.collect()] == [1]
    assert rows(removed) == [(2,), (3,)]
    assert len(rows(unmatched_keys(contacts, texts, "vid"))) == n - 3
    members = spark.createDataFrame([(9, 1)], "list_id int, vid long")
    listed = rows(add_members(members, 9, vids=texts))
    assert listed == sorted([(9, k) for k in range(1, n + 1)], key=str)
    mails = [f"{k}@x" for k in range(n - 1)] + ["b@x"]
    by_mail = add_members(members, 9, contacts, emails=mails)
    assert rows(by_mail) == [(9, 1), (9, 2)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lookup_batch(contacts, [*texts, "x"], "vid").collect()


def test_keys_in_a_table_become_a_join(spark, contacts, plan_of):
    keys = spark.range(5000).withColumnRenamed("id", "vid")
    query = lookup_batch(contacts, keys, "vid")
    assert rows(query) == rows(contacts)
    assert "LeftSemi" in plan_of(query)


def updates(spark, items):
    return spark.createDataFrame(
        items, "vid long, seq int, property string, value string"
    )


def test_upsert_changes_only_named_properties(spark, contacts):
    changes = updates(
        spark,
        [
            (1, 1, "name", "Old"),
            (1, 2, "name", "Anna"),
            (1, 1, "age", "11"),
            (2, 1, "email", None),
            (9, 1, "age", "99"),
        ],
    )
    assert rows(upsert(contacts, changes, "vid", "seq")) == [
        (1, "a@x", "Anna", 11),
        (2, None, "Bob", None),
        (3, None, "Cy", 30),
        (9, None, None, 99),
    ]


def test_later_null_wins_over_earlier_value(spark, contacts):
    changes = updates(
        spark, [(1, 1, "name", "X"), (1, 2, "name", None), (1, 3, "age", "5")]
    )
    got = upsert(contacts, changes, "vid", "seq").filter("vid = 1")
    assert rows(got) == [(1, "a@x", None, 5)]


def test_order_inside_one_record(spark, contacts):
    df = spark.sql(
        """
        SELECT 1L AS vid, 7 AS seq, array(
          named_struct('property', 'name', 'value', 'First'),
          named_struct('property', 'name', 'value', 'Second')) AS properties
        """
    )
    changes = property_updates(df, "vid", "seq")
    got = upsert(contacts, changes, "vid", ["seq", "pos"]).filter("vid = 1")
    assert got.first().name == "Second"


def test_upsert_refuses_what_it_cannot_place(spark, contacts):
    with pytest.raises(Exception, match="unknown property: nickname"):
        upsert(
            contacts, updates(spark, [(1, 1, "nickname", "x")]), "vid", "seq"
        ).collect()
    with pytest.raises(Exception, match="update without vid"):
        upsert(
            contacts, updates(spark, [(None, 1, "name", "x")]), "vid", "seq"
        ).collect()


def test_contacts_without_properties_are_inserted(spark):
    target = spark.createDataFrame([("a", "n")], "vid string, name string")
    contacts = spark.sql(
        """
        SELECT * FROM VALUES
          ('k', 1, array()), ('a', 2, array()),
          ('b', 3, array(named_struct('property', 'name', 'value', 'B'))),
          ('b', 4, array())
        AS t(vid, seq, properties)
        """
    )
    changes = property_updates(contacts, "vid", "seq")
    assert rows(upsert(target, changes, "vid", ["seq", "pos"])) == [
        ("a", "n"),
        ("b", "B"),
        ("k", None),
    ]


def test_upsert_refuses_a_null_property(spark, contacts):
    with pytest.raises(Exception, match="unknown property: NULL"):
        upsert(
            contacts, updates(spark, [(1, 1, None, "x")]), "vid", "seq"
        ).collect()


def test_upsert_by_vid_or_else_by_email(spark, contacts):
    changes = spark.createDataFrame(
        [
            (1, "ignored@x", 1, "name", "Anna"),
            (None, "b@x", 1, "name", "Bobby"),
            (2, None, 2, "age", "20"),
            (None, "new@x", 1, "name", "New"),
            (None, "new@x", 2, "name", "Newer"),
            (None, "bare@x", 1, "", None),
            (9, None, 1, "", None),
        ],
        "vid long, email string, seq int, property string, value string",
    )
    got = upsert(contacts, changes, "vid", "seq", other_key="email")
    assert rows(got) == sorted(
        [
            (1, "a@x", "Anna", 10),
            (2, "b@x", "Bobby", 20),
            (3, None, "Cy", 30),
            (9, None, None, None),
            (None, "new@x", "Newer", None),
            (None, "bare@x", None, None),
        ],
        key=str,
    )
    nobody = spark.createDataFrame(
        [(None, None, 1, "name", "x")], changes.schema
    )
    with pytest.raises(Exception, match="update without vid and email"):
        upsert(contacts, nobody, "vid", "seq", other_key="email").collect()


def test_upsert_agrees_with_row_by_row(spark):
    import random

    rng = random.Random(3)
    start = {k: {"p": f"p{k}", "q": f"q{k}"} for k in range(40)}
    target = spark.createDataFrame(
        [(k, v["p"], v["q"]) for k, v in start.items()],
        "vid long, p string, q string",
    )
    # A third of the changes falls on one key.
    items = [
        (
            5 if rng.random() < 0.33 else rng.randrange(60),
            seq,
            rng.choice("pq"),
            rng.choice([None, "x", "y", "z"]),
        )
        for seq in range(600)
    ]
    for key, _, name, value in items:
        start.setdefault(key, {"p": None, "q": None})[name] = value
    got = upsert(target, updates(spark, items), "vid", "seq")
    assert {r.vid: {"p": r.p, "q": r.q} for r in got.collect()} == start
    assert got.count() == len(start)


def test_masked_update_keeps_the_rest(spark, contacts):
    new = spark.createDataFrame(
        [(1, "z@x", None, 1, 1), (1, "y@x", None, 2, 2), (8, "w", "W", 8, 1)],
        "vid long, email string, name string, age int, seq int",
    )
    got = masked_update(contacts, new, "vid", mask=["email", "name"], seq="seq")
    assert rows(got) == [
        (1, "y@x", None, 10),
        (2, "b@x", "Bob", None),
        (3, None, "Cy", 30),
    ]


def test_second_update_needs_an_order(spark, contacts):
    new = contacts.union(contacts)
    with pytest.raises(Exception, match="several updates"):
        masked_update(contacts, new, "vid", mask=["name"]).collect()


def test_masks_of_the_records(spark, contacts):
    new = spark.sql(
        """
        SELECT * FROM VALUES (1L, 'N1', 91, array('name')),
          (2L, 'N2', 92, array('age', 'name')), (3L, 'N3', 93, array())
          AS t(vid, name, age, mask)
        """
    )
    got = masked_update(contacts, new, "vid", mask_column="mask")
    assert rows(got.drop("email")) == [(1, "N1", 10), (2, "N2", 92), (3, "Cy", 30)]


def test_nested_masks(spark):
    schema = "id int, p struct<a:int,b:struct<c:int,d:int>>"
    old = spark.createDataFrame(
        [(1, (1, (1, 1))), (2, None), (3, (3, None)), (4, None)], schema
    )
    new = spark.createDataFrame(
        [(1, (9, (9, 9))), (2, (9, (9, 9))), (3, (9, (9, None))), (4, None)],
        schema,
    )
    got = masked_update(old, new, "id", mask=["p.b.c"]).orderBy("id")
    assert [r.p and r.p.asDict(True) for r in got.collect()] == [
        {"a": 1, "b": {"c": 9, "d": 1}},
        {"a": None, "b": {"c": 9, "d": None}},
        {"a": 3, "b": {"c": 9, "d": None}},
        None,
    ]
    with pytest.raises(ValueError, match="unknown"):
        masked_update(old, new, "id", mask=["p.z"])
    with pytest.raises(ValueError):
        masked_update(old, new, "id")


def test_delete(spark, contacts):
    keys = spark.createDataFrame([(1,), (1,), (9,)], "vid long")
    for given in ([1, 9], keys):
        rest, removed = delete_keys(contacts, given, "vid")
        assert sorted(r.vid for r in rest.collect()) == [2, 3]
        assert rows(removed) == [(1,)]
    rest, removed = delete_all(contacts, "vid")
    assert rest.count() == 0 and rows(removed) == [(1,), (2,), (3,)]


def test_rows_without_a_key_are_not_deleted(spark):
    df = spark.createDataFrame([(None,), (1,)], "vid long")
    keys = spark.createDataFrame([(1,), (None,)], "vid long")
    for given in ([1], keys):
        assert rows(delete_keys(df, given, "vid")[0]) == [(None,)]


def test_members(spark, contacts):
    members = spark.createDataFrame([("L", 1), ("M", 2)], "list_id string, vid long")
    got = add_members(members, "L", contacts, emails=["b@x", "none"], vids=[1, 3])
    assert rows(got) == [("L", 1), ("L", 2), ("L", 3), ("M", 2)]
    assert rows(list_members(got, contacts, "L", ["name"])) == [
        ("L", 1, "Ann"),
        ("L", 2, "Bob"),
        ("L", 3, "Cy"),
    ]
    assert rows(contact_lists(got)) == [("L", 3), ("M", 1)]
    assert rows(contact_lists(got, "M")) == [("M", 1)]
    with pytest.raises(ValueError):
        add_members(members, "L", contacts, emails=[], vids=[])


def test_edges_are_a_set(spark):
    def edges(*ids):
        return spark.createDataFrame(
            [("o", i, "c", "1", "t") for i in ids],
            ", ".join(f"{c} string" for c in EDGE_COLUMNS),
        )

    got = associate(edges("1", "3"), edges("1", "2", "2"))
    assert sorted(r.object_id for r in got.collect()) == ["1", "2", "3"]
    with pytest.raises(Exception, match="edge with a missing column"):
        associate(edges("1"), edges("2", None)).collect()


def test_small_updates_do_not_shuffle_the_target(spark, tmp_path):
    """With few updates the large side is read and joined in place."""
    path = str(tmp_path / "target")
    spark.range(200_000).select(
        F.col("id").alias("vid"), F.lit("x").alias("name")
    ).write.parquet(path)
    target = spark.read.parquet(path)
    few = updates(spark, [(5, 1, "name", "y")])
    for query in (
        upsert(target, few, "vid", "seq"),
        masked_update(
            target, few.select("vid", F.lit("n").alias("name")), "vid", ["name"]
        ),
        delete_keys(target, few.select("vid"), "vid")[0],
        lookup_batch(target, few.select("vid"), "vid"),
    ):
        query.collect()
        final = query._jdf.queryExecution().executedPlan().toString()
        final = final.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" not in final
        for part in final.split("ShuffleQueryStage")[1:]:
            # Only the updates, and keys already joined with them, move.
            assert "200000" not in part.split("\n")[0]


def test_upsert_by_email_finds_keys_of_the_same_batch(spark, contacts):
    """A contact inserted with an email and an update for that email in one
    batch give one contact; an email a keyed update moves away is free."""
    changes = spark.createDataFrame(
        [
            (9, None, 1, "email", "e@f"),
            (None, "e@f", 2, "name", "Eve"),
            (1, None, 1, "email", "z@x"),
            (None, "a@x", 2, "name", "Other"),
            (None, "z@x", 3, "age", "11"),
        ],
        "vid long, email string, seq int, property string, value string",
    )
    got = upsert(contacts, changes, "vid", "seq", other_key="email")
    assert rows(got) == sorted(
        [
            (1, "z@x", "Ann", 11),
            (2, "b@x", "Bob", None),
            (3, None, "Cy", 30),
            (9, "e@f", "Eve", None),
            (None, "a@x", "Other", None),
        ],
        key=str,
    )
