from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Table
from pactlake.operators.layout import (
    add_partition_columns, between, join_hybrid, join_pruned, matching, read_partitioned, stored_schema, write_bucketed,
    write_hybrid, write_partitioned,
)

COLUMNS = (Column("id", "long", False), Column("name", "string"), Column("at", "timestamp"))


def table(*specs: Partition) -> Table:
    return Table("t", "bronze", COLUMNS, partitions=specs)


@pytest.fixture
def data(spark):
    return spark.range(0, 2000).select(
        "id",
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
        (F.lit("2023-12-30 00:30:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"),
    )


@pytest.mark.parametrize(
    "spec, expected",
    [
        (Partition("at", "year"), 2023), (Partition("at", "month"), "2023-12"), (Partition("at", "day"), dt.date(2023, 12, 30)),
        (Partition("at", "hour"), "2023-12-30-05"), (Partition("name", "truncate", width=1), "n"),
        (Partition("id", "truncate", width=4), 4), (Partition("id"), 5),
    ],
)
def test_transforms(data, spec, expected):
    row = add_partition_columns(data, table(spec)).where("id = 5").first()
    assert row[spec.field_name] == expected


def test_truncate_floors_negative_numbers(spark):
    df = spark.createDataFrame([(-1, "a", None)], "id long, name string, at timestamp_ntz")
    assert add_partition_columns(df, table(Partition("id", "truncate", width=10))).first()["__p_id_truncate"] == -10


def test_buckets_are_in_range_also_for_null(data, spark):
    null = spark.createDataFrame([(None, None, None)], "id long, name string, at timestamp_ntz")
    spec = Partition("name", "bucket", num_buckets=7)
    out = add_partition_columns(data.unionByName(null), table(spec))
    assert out.where(~F.col(spec.field_name).between(0, 6)).isEmpty()


@pytest.mark.parametrize(
    "spec, column, low, high",
    [
        (Partition("at", "day"), "at", "2024-01-03 05:00:00", "2024-01-04 07:30:00"),
        (Partition("at", "month"), "at", "2024-01-31 00:00:00", "2024-02-01 07:30:00"),
        (Partition("at", "hour"), "at", "2024-01-03 05:10:00", "2024-01-03 07:30:00"),
        (Partition("at", "year"), "at", "2023-12-31 22:00:00", "2023-12-31 23:30:00"),
        (Partition("id", "truncate", width=100), "id", 150, 420),
        (Partition("name", "truncate", width=3), "name", "n15", "n169"),
        (Partition("id", "bucket", num_buckets=5), "id", 77, 77),
    ],
)
def test_pruned_read_equals_plain_filter(spark, data, tmp_path, spec, column, low, high):
    t, path = table(spec), str(tmp_path / "t")
    write_partitioned(data, t, path)
    pruned = between(read_partitioned(spark, t, path), t, column, low, high)
    bound = (lambda v: F.lit(v).cast("timestamp_ntz")) if column == "at" else F.lit
    expected = data.where(F.col(column).between(bound(low), bound(high)))
    assert sorted(r.id for r in pruned.collect()) == sorted(r.id for r in expected.collect())
    assert expected.count() > 0
    text = plan(pruned)
    filters = text[text.index("PartitionFilters: [") :].split("]")[0]
    assert spec.field_name in filters


def test_month_partitions_stay_text(spark, data, tmp_path):
    t, path = table(Partition("at", "month")), str(tmp_path / "t")
    write_partitioned(data, t, path)
    assert read_partitioned(spark, t, path).schema == stored_schema(t)
    assert "2024-01" in {r[0] for r in read_partitioned(spark, t, path).select("__p_at_month").distinct().collect()}


def test_overwrite_replaces_only_the_partitions_written(spark, data, tmp_path):
    t, path = table(Partition("at", "month")), str(tmp_path / "t")
    write_partitioned(data, t, path)
    write_partitioned(data.where("at < '2024-01-01'").limit(1), t, path, mode="overwrite")
    out = read_partitioned(spark, t, path)
    assert out.where("at < '2024-01-01'").count() == 1
    assert out.where("at >= '2024-01-01'").count() == data.where("at >= '2024-01-01'").count()


def test_bucketed_tables_join_without_shuffle(spark, data, tmp_path):
    for name in ("left_b", "right_b"):
        write_bucketed(data, name, Partition("id", "bucket", num_buckets=4), str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


DAILY = Table(
    "t", "bronze", (Column("id", "long"), Column("at", "timestamp"), Column("name", "string"), Column("n", "integer")),
    partitions=(Partition("at", "day"), Partition("id", "bucket", num_buckets=4), Partition("name", "truncate", width=1), Partition("n", "truncate", width=10)),
)


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily") / "t")
    df = spark.range(60).selectExpr(
        "IF(id % 20 = 7, NULL, id) AS id", "IF(id % 15 = 2, NULL, TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id * 3)) AS at",
        "IF(id % 12 = 5, NULL, concat(char(97 + id % 5), id)) AS name", "CAST(id - 25 AS int) AS n",
    )
    write_partitioned(df, DAILY, path)
    return read_partitioned(spark, DAILY, path)


@pytest.mark.parametrize("predicate, field", [
    (("at", "=", "2024-01-02 03:00:00"), "__p_at_day"), (("at", "in", ["2024-01-02 03:00:00", "2024-01-04 00:00:00"]), "__p_at_day"),
    (("at", "<", "2024-01-03 00:00:00"), "__p_at_day"), (("at", "<=", "2024-01-03 00:00:00"), "__p_at_day"), (("at", ">", "2024-01-03 21:00:00"), "__p_at_day"),
    (("at", ">=", "2024-01-03 21:00:00"), "__p_at_day"), (("at", "is null"), "__p_at_day"), (("id", "=", 11), "__p_id_bucket"),
    (("id", "in", [11, 12, 58]), "__p_id_bucket"), (("id", "is null"), "__p_id_bucket"), (("name", ">=", "d13"), "__p_name_truncate"),
    (("name", "<", "b"), "__p_name_truncate"), (("name", "=", "a10"), "__p_name_truncate"), (("n", "<", -11), "__p_n_truncate"), (("n", ">", 18), "__p_n_truncate"),
])
def test_predicates_reach_the_partitions(daily, predicate, field):
    column, operation, *value = predicate
    typed = (f"TIMESTAMP_NTZ '{v}'" if column == "at" else repr(v) for v in (value[0] if operation == "in" else value))
    sql = f"{column} {operation} ({', '.join(typed)})" if operation == "in" else " ".join([column, operation, *typed])
    found = matching(daily, DAILY, [predicate])
    key = lambda rows: sorted(map(str, rows))
    assert key(found.collect()) == key(daily.where(sql).collect()) != []
    assert field in plan(found).split("PartitionFilters")[1].split("PushedFilters")[0]


def test_predicates_that_say_nothing_of_partitions(daily):
    assert matching(daily, DAILY, [("id", ">", 50), ("id", "is not null")]).count() == 9
    assert "__p_id_bucket" not in plan(matching(daily, DAILY, [("id", ">", 50)])).split("PartitionFilters")[1].split("PushedFilters")[0]
    with pytest.raises(ValueError, match="unknown operation"):
        matching(daily, DAILY, [("id", "like", "a")])


def test_a_dimension_prunes_the_facts(spark, daily, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(60).selectExpr("id", "id % 30 AS kind").write.parquet(path)
    wanted = spark.read.parquet(path).where("kind = 4").select("id")
    found = join_pruned(daily, DAILY, wanted, "id")
    assert sorted(r.id for r in found.collect()) == [4, 34] and "dynamicpruning" in plan(found).lower()
    assert "id" in found.columns and found.columns.count("__p_id_bucket") == 1
    with pytest.raises(ValueError, match="all rows"):
        join_pruned(daily, DAILY, wanted, "id", "left")


@pytest.mark.parametrize("left_hot, right_hot", [(True, False), (False, True), (True, True), (False, False)])
def test_hybrid_join(spark, tmp_path, left_hot, right_hot):
    name = f"hybrid_{left_hot}_{right_hot}".lower()
    hot = lambda n: f"IF(id % 3 = 0 AND {n}, 5, IF(id % 29 = 0, NULL, id % 40)) AS k"
    left, right = spark.range(600).selectExpr(hot(left_hot), "id AS l"), spark.range(200).selectExpr(hot(right_hot), "id AS r")
    one = write_hybrid(left, f"{name}_l", "k", str(tmp_path / "l"), rows_per_task=60)
    two = write_hybrid(right, f"{name}_r", "k", str(tmp_path / "r"), one.buckets, rows_per_task=60)
    assert one.buckets == two.buckets == 16
    assert spark.table(one.rest).where("k IS NULL").isEmpty()
    assert spark.table(one.rest).groupBy("k").count().agg(F.max("count")).first()[0] <= 60
    assert {r.k for r in spark.table(one.aside).select("k").distinct().collect()} == ({5, None} if left_hot else {None})
    joined = join_hybrid(spark, one, two, 60)
    assert joined.columns == ["k", "l", "r"]
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        in_place = plan(spark.table(one.rest).join(spark.table(two.rest), "k"))
        assert "Exchange" not in in_place and "SortMergeJoin" in in_place
    finally:
        spark.conf.set(threshold, before)
    with pytest.raises(ValueError, match="differ"):
        join_hybrid(spark, one, replace(two, key="r"))


def test_hybrid_buckets_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pactlake.operators.layout.MAX_BUCKETS", 4, raising=False)
    left, right = spark.range(900).selectExpr("id % 300 AS k", "id AS l"), spark.range(300).selectExpr("id AS k", "id AS r")
    one = write_hybrid(left, "hybrid_many_l", "k", str(tmp_path / "l"), rows_per_task=10)
    two = write_hybrid(right, "hybrid_many_r", "k", str(tmp_path / "r"), one.buckets, rows_per_task=10)
    assert one.buckets == two.buckets == 4
    joined = join_hybrid(spark, one, two, 10)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
