"""One key holding a third of all rows: results stay whole and the hot
partition is split."""

import pytest
from pyspark.sql import functions as F

from opsframe.operators import (
    answers_wide,
    batch_ids,
    delete_keys,
    list_members,
    lookup_batch,
    masked_update,
    upsert,
)

ROWS = 300_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Rows ``vid, n, pad``; vid 7 has a third of them."""
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    spark.range(ROWS).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000).alias("vid"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture()
def large_joins(spark):
    """Settings under which these sizes count as large and skewed."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keys(spark):
    return spark.range(500, 200_000, 2).select(F.col("id").alias("vid")).union(
        spark.range(7, 8).select("id")
    )


def _upserted(target, wanted):
    changes = wanted.select(
        "vid",
        F.lit(1).alias("seq"),
        F.lit("pad").alias("property"),
        F.lit("new").alias("value"),
    )
    return upsert(target, changes, "vid", "seq")


def test_hot_key_is_split_in_joins(spark, skewed, large_joins):
    wanted = keys(spark)
    chosen = skewed.filter((F.col("vid") == 7) | (
        (F.col("vid") < 200_000) & (F.col("vid") % 2 == 0)
    )).count()
    held = wanted.join(skewed, "vid", "left_semi").count()
    updates = wanted.select("vid", F.lit(-1).cast("long").alias("n"))
    members = wanted.select(F.lit("L").alias("list_id"), "vid")
    checks = [
        (lookup_batch(skewed, wanted, "vid"), chosen),
        (delete_keys(skewed, wanted, "vid")[0], ROWS - chosen),
        (masked_update(skewed, updates, "vid", mask=["n"]), ROWS),
        (list_members(members, skewed), chosen),
        (_upserted(skewed, wanted), ROWS + wanted.count() - held),
    ]
    for df, number in checks:
        # Collected from the frame itself, whose final plan is looked at.
        assert df.toArrow().num_rows == number
        assert "skew=true" in final_plan(df)
    changed = masked_update(skewed, updates, "vid", mask=["n"])
    assert changed.filter("n = -1").count() == chosen


def test_hot_key_is_reduced_before_the_shuffle(spark, skewed, plan_of):
    updates = skewed.select(
        "vid", F.col("n").alias("seq"), F.lit("name").alias("property"),
        F.col("pad").alias("value"),
    )
    target = spark.range(5, 10).select(
        F.col("id").alias("vid"), F.lit("old").alias("name")
    )
    df = upsert(target, updates, "vid", "seq")
    assert "partial_max_by" in plan_of(df)
    last = skewed.filter("vid = 7").agg(F.max_by("pad", "n")).first()[0]
    got = df.filter("vid < 10").collect()
    assert {r.vid: r.name for r in got} == {
        5: "old", 6: "old", 7: last, 8: "old", 9: "old",
    }
    assert df.count() == 4 + skewed.select("vid").distinct().count()
    wide = answers_wide(
        skewed.withColumn("q", F.lit("q")), "vid", "q", "pad", "n", ["q"]
    )
    assert "partial_min_by" in plan_of(wide)


def test_hot_group_is_numbered_in_pieces(spark, skewed):
    df = batch_ids(skewed.select("vid", "n"), 1000, "n", within=["vid"])
    sizes = df.filter("vid = 7").groupBy("batch").count().collect()
    assert sorted(r.batch for r in sizes) == list(range(ROWS // 3000))
    assert {r["count"] for r in sizes} == {1000}
    wrong = df.filter("vid = 7 AND batch <> n div 3000").count()
    assert wrong == 0
