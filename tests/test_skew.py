from __future__ import annotations

import re

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.functions.skew import heaviest, latest_per_key, skew_join, spread


@pytest.fixture
def skewed(spark):
    """A third of the rows on key 0, a third without a key, copies throughout."""
    return spark.range(900).select(
        F.when(F.col("id") < 300, 0).when(F.col("id") < 600, None).otherwise(F.col("id") % 60).alias("k"),
        (F.col("id") % 7).alias("x"),
    ).repartition(4)


def bag(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    right = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c"), (50, "d"), (77, "e")], "k long, y string")
    skewed = skewed.withColumn("k", F.col("k").cast("long"))
    assert bag(skew_join(skewed, right, ["k"], how, rows_per_task=50)) == bag(skewed.join(right, ["k"], how))


def test_skew_join_on_two_keys(spark, skewed):
    right = spark.createDataFrame([(0, 1, "a"), (3, 2, "b")], "k int, x long, y string")
    left = skewed.withColumn("k", F.col("k").cast("int"))
    assert bag(skew_join(left, right, ["k", "x"], "left", rows_per_task=20)) == bag(left.join(right, ["k", "x"], "left"))


def test_skew_join_shuffles_by_key_and_salt(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(skew_join(skewed, spark.range(60).toDF("k"), ["k"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"Exchange hashpartitioning\(.*__salt#", text)) == 2


def test_hot_rows_are_spread(skewed):
    salts = skewed.where("k = 0").select(spread(F.col("k")).alias("s")).distinct().count()
    assert salts == skewed.rdd.getNumPartitions()


def test_heavy_is_what_exceeds_a_task(skewed):
    counts = skewed.groupBy("k").count()
    assert {r.k for r in heaviest(counts, rows_per_task=200).collect()} == {0, None}
    assert heaviest(counts, rows_per_task=400).isEmpty()


def test_the_key_after_a_thousand_heavier_ones_is_split_too(spark):
    left = spark.range(1200 * 30).select((F.col("id") % 1200).alias("k")).repartition(8)
    right = spark.range(1200).toDF("k")
    joined = skew_join(left, right, ["k"], "inner", rows_per_task=10)
    assert joined.count() == 1200 * 30
    assert joined.where("k = 1100").count() == 30


def test_skew_join_reads_only_the_columns_it_needs(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).selectExpr("id k", "id a", "CAST(id AS string) b").write.parquet(path)
    text = plan(skew_join(spark.read.parquet(path), spark.range(10).toDF("k"), ["k"], "left").select("k", "a"))
    assert all("b:string" not in schema.split(">")[0] for schema in text.split("ReadSchema: ")[1:])


def test_latest_per_key_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 1, "one"), (None, 5, "nokey")], "k int, at int, v string")
    assert {(r.k, r.v) for r in latest_per_key(df, ["k"], ["at"]).collect()} == {(1, "one"), (None, "nokey")}
