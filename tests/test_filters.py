from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

from opsframe.operators import (
    check_filters,
    date_range,
    filter_groups,
    incremental_pull,
    normalise_columns,
    optional_filters,
    pascal_columns,
    select_properties,
    since,
)


def item(name, operator, value):
    return {"propertyName": name, "operator": operator, "value": value}


@pytest.fixture(scope="module")
def calls(spark):
    rows = [
        (1, "a", 1.5, datetime(2024, 1, 1)),
        (2, "b", 2.0, datetime(2024, 1, 1, 23, 59, 59, 999999)),
        (3, "a", 3.0, datetime(2024, 1, 2)),
        (4, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "id int, kind string, size double, at timestamp_ntz"
    )


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "operator, expected",
    [
        ("EQ", [2]),
        ("NEQ", [1, 3]),
        ("LT", [1]),
        ("LTE", [1, 2]),
        ("GT", [3]),
        ("GTE", [2, 3]),
    ],
)
def test_operators(calls, operator, expected):
    assert ids(filter_groups(calls, [item("size", operator, 2)])) == expected


def test_groups_are_ored_and_filters_anded(calls):
    one = [item("kind", "EQ", "a"), item("size", "GT", 2)]
    other = [item("id", "EQ", 2)]
    assert ids(filter_groups(calls, one)) == [3]
    assert ids(filter_groups(calls, [one, other])) == [2, 3]
    assert ids(filter_groups(calls, [])) == [1, 2, 3, 4]
    assert ids(filter_groups(calls, [one, []])) == [1, 2, 3, 4]


@pytest.mark.parametrize(
    "bad",
    [
        "x",
        [1],
        [{"propertyName": "a", "operator": "EQ"}],
        [item(1, "EQ", 2)],
        [item("id", "LIKE", 2)],
        [item("id", 3, 2)],
    ],
)
def test_bad_filters(bad):
    with pytest.raises(ValueError):
        check_filters(bad)


def test_fraction_against_an_integer_column(calls):
    assert ids(filter_groups(calls, [item("id", "GT", 1.5)])) == [2, 3, 4]


def test_decimals_are_not_rounded(calls):
    half = Decimal("1.5")
    assert ids(filter_groups(calls, [item("id", "EQ", half)])) == []
    assert ids(filter_groups(calls, [item("id", "LT", half)])) == [1]
    assert ids(filter_groups(calls, [item("size", "EQ", half)])) == [1]


NOON = datetime(2024, 1, 2, 12)
MIDNIGHT_MS = 1704153600000  # of 2024-01-02


@pytest.mark.parametrize(
    "operator, value, expected",
    [
        ("EQ", NOON, []),
        ("NEQ", NOON, [1, 2, 3]),
        ("LT", NOON, [1, 2]),
        ("LTE", NOON, [1, 2]),
        ("GT", NOON, [3]),
        ("GTE", NOON, [3]),
        ("EQ", MIDNIGHT_MS, [2]),
        ("LT", MIDNIGHT_MS, [1]),
        ("GTE", MIDNIGHT_MS, [2, 3]),
        ("GTE", MIDNIGHT_MS + 1, [3]),
        ("EQ", date(2024, 1, 2), [2]),
        ("GT", "2024-01-02", [3]),
    ],
)
def test_times_against_a_date_column(spark, operator, value, expected):
    rows = [(k, date(2024, 1, k)) for k in (1, 2, 3)] + [(4, None)]
    df = spark.createDataFrame(rows, "id int, day date")
    assert ids(filter_groups(df, [item("day", operator, value)])) == expected
    if operator == "GTE":
        assert ids(since(df, "day", value)) == expected


def test_cutoff_is_inclusive_in_all_forms(calls):
    for after in (
        datetime(2024, 1, 2),
        date(2024, 1, 2),
        1704153600000,
        datetime(2024, 1, 2, tzinfo=timezone.utc),
    ):
        assert ids(since(calls, "at", after)) == [3]


def test_date_range_includes_the_whole_last_day(calls):
    day = date(2024, 1, 1)
    assert ids(date_range(calls, "at", day, day)) == [1, 2]


def test_incremental_pull_leaves_out_seen_rows(spark, calls):
    seen = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1)),
            (3, datetime(2024, 1, 1)),  # changed since
            (9, datetime(2024, 1, 1)),
        ],
        "id int, at timestamp_ntz",
    )
    pulled = incremental_pull(calls, "at", date(2024, 1, 1), "id", seen)
    assert ids(pulled) == [2, 3]
    with pytest.raises(ValueError, match="seen must have"):
        incremental_pull(calls, "at", date(2024, 1, 1), "id", seen.drop("at"))


def test_incremental_pull_of_the_latest_rows(spark):
    rows = [(1, "old", datetime(2024, 1, 2)), (1, "new", datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, "id int, v string, at timestamp_ntz")
    got = incremental_pull(df, "at", date(2024, 1, 1), "id", latest=True)
    assert [tuple(r) for r in got.collect()] == [rows[1]]


def test_unset_filters_are_left_out(calls):
    assert ids(optional_filters(calls, kind="a", size=None)) == [1, 3]
    assert ids(optional_filters(calls, kind="", id=3)) == [3]
    assert ids(optional_filters(calls, id=0)) == []
    assert ids(optional_filters(calls, at=date(2024, 1, 1))) == [1, 2]
    assert ids(optional_filters(calls)) == [1, 2, 3, 4]


def test_column_names(spark):
    df = spark.range(1).toDF("Event Time")
    assert normalise_columns(df).columns == ["event_time"]
    df = spark.range(1).toDF("inbound_request_url")
    assert pascal_columns(df).columns == ["InboundRequestUrl"]
    clash = spark.sql("SELECT 1 AS `A B`, 2 AS `a_b`")
    with pytest.raises(ValueError, match="collide"):
        normalise_columns(clash)


def test_selecting_properties(calls):
    assert select_properties(calls, ["size"], ["id"]).columns == ["id", "size"]
    assert select_properties(calls, []).columns == calls.columns


def test_predicates_and_columns_reach_the_scan(tables, plan_of):
    orders = tables("orders")
    query = filter_groups(
        since(orders, "o_orderdate", 928195200000),
        [item("o_orderstatus", "EQ", "F"), item("o_totalprice", "GTE", 10)],
    ).select("o_orderkey")
    plan = plan_of(query)
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    for part in (
        "GreaterThanOrEqual(o_orderdate,1999-06-01T00:00)",
        "EqualTo(o_orderstatus,F)",
        "GreaterThanOrEqual(o_totalprice,10.0)",
    ):
        assert part in pushed
    assert "o_orderpriority" not in plan


def test_date_filters_reach_the_scan(tables, plan_of):
    plan = plan_of(
        optional_filters(tables("events"), ts=date(2024, 1, 5), event_type="view")
    )
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in plan
    assert "LessThan(ts,2024-01-06T00:00)" in plan
    assert "EqualTo(event_type,view)" in plan


def test_latest_keeps_every_row_without_a_key_and_breaks_ties_alike(spark):
    from datetime import datetime

    rows = [
        (1, datetime(2024, 1, 2), "a"),
        (1, datetime(2024, 1, 2), "b"),
        (1, datetime(2024, 1, 1), "c"),
        (None, datetime(2024, 1, 3), "x"),
        (None, datetime(2024, 1, 3), "y"),
        (None, datetime(2024, 1, 1), "z"),
        (2, datetime(2023, 1, 1), "old"),
    ]
    schema = "id int, at timestamp, v string"
    picks = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        got = incremental_pull(df, "at", date(2024, 1, 1), "id", latest=True)
        got = sorted(got.collect(), key=str)
        assert sorted(r.v for r in got if r.id is None) == ["x", "y", "z"]
        picks.add(tuple(r.v for r in got if r.id == 1))
        assert [r.id for r in got].count(1) == 1 and 2 not in [r.id for r in got]
    assert len(picks) == 1 and picks.pop()[0] in ("a", "b")
