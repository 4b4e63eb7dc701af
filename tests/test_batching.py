from pyspark.sql import functions as F

from opsframe.operators import batch_ids, batching, index_rows


def test_index_over_all_rows(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    got = index_rows(df, "k").collect()
    assert all(r.k == r.row_idx for r in got) and len(got) == 5000


def test_batches_follow_the_order(spark):
    df = spark.range(1, 1002)
    got = {r.id: r.batch for r in batch_ids(df, 100, F.desc("id")).collect()}
    assert got == {i: (1001 - i) // 100 for i in range(1, 1002)}


def test_index_within_groups_with_a_hot_group(spark):
    """A third of all rows in one group, a group of one row, and NULL keys."""
    rows = [("hot", i) for i in range(3000)]
    rows += [(f"g{i % 50}", i) for i in range(5000)]
    rows += [("one", 0), (None, 5), (None, 3)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(8)
    got = index_rows(df, "k", within=["g"]).collect()
    assert len(got) == len(rows)
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.row_idx, r.k))
    for group, pairs in by_group.items():
        keys = sorted(k for g, k in rows if g == group)
        assert sorted(pairs) == list(enumerate(keys))


def test_one_order_value_does_not_fill_one_partition(spark):
    """Rows tied on the order are still spread over the partitions."""
    df = spark.range(20_000).select("id", F.lit(1).alias("same"))
    got = index_rows(df, "same")
    assert sorted(r.row_idx for r in got.collect()) == list(range(20_000))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int")
    assert batch_ids(df, 10, "k").count() == 0


def test_index_is_the_same_each_time_it_is_read(spark):
    df = spark.range(3000).select(F.rand(1).alias("r"), "id")
    indexed = index_rows(df, "r")
    assert sorted(indexed.collect()) == sorted(indexed.collect())


def test_groups_are_joined_without_a_hint(spark):
    df = spark.range(300).select((F.col("id") % 7).alias("g"), "id")
    got = index_rows(df, "id", within=["g"])
    assert "broadcast" not in got._jdf.queryExecution().analyzed().toString()
    assert all(r.row_idx == r.id // 7 for r in got.collect())


def test_copies_of_few_rows_are_spread(spark):
    """Rows that are alike in all columns still fill partitions evenly."""
    df = spark.range(0, 60_000, 1, 6).select((F.col("id") % 3).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = batching._ranged(df, [F.col("v")])
        sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 25_000
    got = index_rows(df, "v").collect()
    assert sorted(r.row_idx for r in got) == list(range(60_000))
    assert all(r.v == r.row_idx // 20_000 for r in got)


def test_rows_with_maps(spark):
    df = spark.sql(
        "SELECT id, array(map('k', id)) AS held, named_struct('m', map(1, id)) AS s"
        " FROM range(50)"
    )
    assert all(r.row_idx == r.id for r in index_rows(df, "id").collect())


def test_no_window_over_the_rows(spark, plan_of):
    plan = plan_of(index_rows(spark.range(1000), "id"))
    window = plan[: plan.index("Window")]
    assert "BroadcastHashJoin" in window
    # The window runs on the counts per partition only.
    assert "HashAggregate" in plan[plan.index("Window") :]
