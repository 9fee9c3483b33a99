from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Table
from pactlake.operators.layout import (
    add_partition_columns, between, join_hybrid, join_pruned, matching, read_partitioned, write_bucketed, write_hybrid,
    write_partitioned,
)
from pactlake.queries.registry import load, query
from pactlake.session import fresh_folder

ORDERS = (
    Column("o_orderkey", "long", False), Column("o_custkey", "long"), Column("o_orderstatus", "string"),
    Column("o_totalprice", "double"), Column("o_orderdate", "timestamp"), Column("o_orderpriority", "string"),
)
EVENTS = (
    Column("event_id", "long", False), Column("ts", "timestamp"), Column("user_id", "long"),
    Column("event_type", "string"), Column("value", "double"), Column("props", "string"),
)


def _rows_per_partition(df: DataFrame, columns: tuple[Column, ...], spec: Partition) -> DataFrame:
    table = Table("t", "bronze", columns, partitions=(spec,))
    value = F.col(spec.field_name)
    return add_partition_columns(df, table).groupBy(value.cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _orders_by(spark: SparkSession, sf_dir: str, spec: Partition) -> DataFrame:
    return _rows_per_partition(load(spark, sf_dir, "orders"), ORDERS, spec)


@query("SELECT o_orderstatus AS part, count(*) AS n FROM orders GROUP BY 1")
def partition_identity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1"""
    return _orders_by(spark, sf_dir, Partition("o_orderstatus"))


@query("SELECT CAST(year(o_orderdate) AS VARCHAR) AS part, count(*) AS n FROM orders GROUP BY 1")
def partition_year_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2"""
    return _orders_by(spark, sf_dir, Partition("o_orderdate", "year"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS part, count(*) AS n FROM orders GROUP BY 1")
def partition_month_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3"""
    return _orders_by(spark, sf_dir, Partition("o_orderdate", "month"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS part, count(*) AS n FROM events GROUP BY 1")
def partition_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4"""
    return _rows_per_partition(load(spark, sf_dir, "events"), EVENTS, Partition("ts", "day"))


@query("SELECT strftime(ts, '%Y-%m-%d-%H') AS part, count(*) AS n FROM events GROUP BY 1")
def partition_hour_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5"""
    return _rows_per_partition(load(spark, sf_dir, "events"), EVENTS, Partition("ts", "hour"))


@query("""
SELECT count(*) AS n, count(DISTINCT o_custkey) AS keys, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS split_keys
FROM orders
""")
def partition_bucket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket numbers are in range and a key has one bucket."""
    spec = Partition("o_custkey", "bucket", num_buckets=16)
    table = Table("orders", "bronze", ORDERS, partitions=(spec,))
    bucket = F.col(spec.field_name)
    keys = add_partition_columns(load(spark, sf_dir, "orders"), table).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~bucket.between(0, 15)).alias("outside"),
        (F.min(bucket) != F.max(bucket)).alias("split"),
    )
    return keys.agg(
        F.sum("rows").alias("n"), F.count(F.lit(1)).alias("keys"), F.sum("outside").alias("outside"),
        F.count_if("split").alias("split_keys"),
    )


@query("SELECT CAST(o_custkey - o_custkey % 100 AS VARCHAR) AS part, count(*) AS n FROM orders GROUP BY 1")
def partition_truncate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on integers"""
    return _orders_by(spark, sf_dir, Partition("o_custkey", "truncate", width=100))


@query("SELECT substr(url, 1, 12) AS part, count(*) AS n FROM pages GROUP BY 1")
def partition_truncate_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on strings"""
    columns = (Column("page_id", "long"), Column("url", "string"))
    return _rows_per_partition(load(spark, sf_dir, "pages"), columns, Partition("url", "truncate", width=12))


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
       CAST(sum(CAST(CASE WHEN year(o_orderdate) = 1996 THEN 2 ELSE 1 END * o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
         AS total
FROM orders GROUP BY 1
""")
def partition_overwrite_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by month, then replace the months of one year only."""
    table = Table("orders", "bronze", ORDERS, partitions=(Partition("o_orderdate", "month"),))
    folder = fresh_folder(spark, "overwrite")
    orders = load(spark, sf_dir, "orders")
    write_partitioned(orders, table, folder)
    corrected = orders.where(F.year("o_orderdate") == 1996).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_partitioned(corrected, table, folder, mode="overwrite")
    return read_partitioned(spark, table, folder).groupBy(F.col("__p_o_orderdate_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query("""
SELECT event_id, ts, user_id, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:30:00'
""")
def partition_prune_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range on the timestamp reads only the days it touches."""
    table = Table("events", "bronze", EVENTS, partitions=(Partition("ts", "day"),))
    folder = fresh_folder(spark, "prune")
    write_partitioned(load(spark, sf_dir, "events"), table, folder)
    stored = read_partitioned(spark, table, folder)
    return between(stored, table, "ts", "2024-01-10 06:00:00", "2024-01-12 18:30:00").select(
        "event_id", "ts", "user_id", "value"
    )


@query("""
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def bucketed_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables bucketed on the order key join without a shuffle of either."""
    run = uuid.uuid4().hex[:12]
    orders, lines = f"bucketed_orders_{run}", f"bucketed_lines_{run}"
    write_bucketed(
        load(spark, sf_dir, "orders"), orders, Partition("o_orderkey", "bucket", num_buckets=8),
        fresh_folder(spark, "bucketed"),
    )
    write_bucketed(
        load(spark, sf_dir, "lineitem"), lines, Partition("l_orderkey", "bucket", num_buckets=8),
        fresh_folder(spark, "bucketed"),
    )
    joined = spark.table(orders).join(spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
    )


BY_DAY = Table("events", "bronze", EVENTS, partitions=(Partition("ts", "day"), Partition("user_id", "bucket", num_buckets=4)))


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "by_day")
    write_partitioned(load(spark, sf_dir, "events"), BY_DAY, folder)
    return read_partitioned(spark, BY_DAY, folder)


#: Predicates on the events, and the same as SQL.
PREDICATES = (
    ([("ts", "=", "2024-01-05 00:00:00")], "ts = TIMESTAMP '2024-01-05'"),
    ([("ts", ">=", "2024-01-28 12:00:00")], "ts >= TIMESTAMP '2024-01-28 12:00:00'"),
    ([("ts", "<", "2024-01-03 06:00:00"), ("user_id", "in", [1, 2, 3, 50])], "ts < TIMESTAMP '2024-01-03 06:00:00' AND user_id IN (1, 2, 3, 50)"),
    ([("ts", ">", "2024-01-10 00:00:00"), ("ts", "<=", "2024-01-11 00:00:00")], "ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-11'"),
    ([("user_id", "=", 7), ("ts", "is not null")], "user_id = 7"),
    ([("user_id", "is null")], "user_id IS NULL"),
)


@query("\nUNION ALL\n".join(
    f"SELECT {i} AS predicate, count(*) AS n, coalesce(sum(event_id), 0)::BIGINT AS ids FROM events WHERE {sql}" for i, (_, sql) in enumerate(PREDICATES)))
def partition_predicates_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality, lists, half-open ranges and NULL over days and buckets."""
    events = _events_by_day(spark, sf_dir)
    parts = [
        matching(events, BY_DAY, predicates).agg(
            F.lit(i).alias("predicate"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("event_id"), F.lit(0)).alias("ids")
        )
        for i, (predicates, _) in enumerate(PREDICATES)
    ]
    return reduce(DataFrame.unionByName, parts)


@query("""
SELECT o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS orders FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3 AND c_acctbal > 0) GROUP BY 1
""")
def partition_join_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept by customer bucket, read for the customers of a nation; only their buckets are."""
    table = Table("orders", "bronze", ORDERS, partitions=(Partition("o_custkey", "bucket", num_buckets=64),))
    folder = fresh_folder(spark, "by_customer")
    write_partitioned(load(spark, sf_dir, "orders"), table, folder)
    wanted = load(spark, sf_dir, "customer").where("c_nationkey = 3 AND c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    joined = join_pruned(read_partitioned(spark, table, folder), table, wanted, "o_custkey")
    return joined.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("orders"))


@query("""
WITH o AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 WHEN o_custkey % 50 <> 1 THEN o_custkey END AS k, o_orderkey FROM orders),
c AS (SELECT c_custkey AS k, c_nationkey FROM customer UNION ALL SELECT c_custkey % 7, c_nationkey FROM customer WHERE c_custkey < 40)
SELECT c_nationkey, count(*) AS n, sum(o_orderkey)::BIGINT AS orders FROM o JOIN c USING (k) GROUP BY 1
""")
def bucketed_hybrid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders have one customer, some none, and some customers are delivered several times."""
    folder, name, key = fresh_folder(spark, "hybrid"), f"hybrid_{uuid.uuid4().hex[:12]}", F.col("o_custkey")
    orders, customers = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    hot = F.when(key % 3 == 0, F.lit(0).cast("long")).when(key % 50 != 1, key)
    again = customers.where("c_custkey < 40").select((F.col("c_custkey") % 7).alias("k"), "c_nationkey")
    share = 1000
    left = write_hybrid(orders.select(hot.alias("k"), "o_orderkey"), f"{name}_o", "k", f"{folder}/o", rows_per_task=share)
    right = customers.select(F.col("c_custkey").alias("k"), "c_nationkey").unionAll(again)
    right = write_hybrid(right, f"{name}_c", "k", f"{folder}/c", left.buckets, share)
    joined = join_hybrid(spark, left, right, share)
    return joined.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("orders"))
