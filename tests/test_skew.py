"""Joins with null and hot keys: results as those of a plain join, and task sizes."""

import pytest
from pyspark.sql import functions as F

from palmyra.operators.skew import hot_keys, spread_join


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def plain(spark):
    """Neither broadcast nor adaptive execution."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def table(spark, n=20_000):
    """Half of the rows without a key, a quarter with one key, the rest with many."""
    k = F.when(F.col("id") % 4 < 2, None).when(F.col("id") % 4 == 2, 7).otherwise(F.col("id"))
    return spark.range(n).select(k.alias("k"), (F.col("id") % 3).cast("string").alias("k2"), "id")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_equals_a_plain_join(spark, plain, how):
    left = table(spark, 2_000)
    right = spark.createDataFrame([(7, "0", "a"), (7, "1", "b"), (7, "1", "c"), (11, "2", "d"),
                                   (None, "0", "e"), (None, None, "f")], "k long, k2 string, v string")
    for on in (["k"], ["k", "k2"]):
        r = right if len(on) == 2 else right.drop("k2")
        left_side = left if len(on) == 2 else left.drop("k2")
        for hot_left in (True, False):
            got = spread_join(left_side, r, on, how, hot_left=hot_left)
            expect = left_side.join(r, on, how)
            assert rows(got.select(*expect.columns)) == rows(expect)


def test_empty_sides(spark, plain):
    left, right = table(spark, 100), spark.createDataFrame([], "k long, v string")
    assert spread_join(left, right, ["k"]).count() == 100
    assert spread_join(left.limit(0), right, ["k"]).count() == 0


def test_no_task_holds_more_than_twice_the_mean(spark, plain):
    right = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = spread_join(table(spark), right, ["k"], "left", tasks=8)
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000
    # The keyless rows stay where they are read; the others are dealt over the join's tasks.
    assert max(sizes) <= 2 * 20_000 / len(sizes)
    plainly = table(spark).join(right, "k", "left")
    assert max(r.n for r in plainly.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) > 10_000


def test_hot_keys_are_few(spark):
    found = hot_keys(table(spark).where("k IS NOT NULL"), ["k"], tasks=8).collect()
    assert [r.k for r in found] == [7] and found[0]["_parts"] >= 30
    with pytest.raises(ValueError):
        spread_join(table(spark), table(spark), ["k"], "full")
