"""Joins and per-key picks that hold when one key owns a large share of the rows.

A key is heavy when it has more rows than a task should get. There are at most rows / ROWS_PER_TASK of them, about as
many as tasks, so the list of heavy keys is small beside the data, and no key left out is more than a task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key that a task takes without splitting.
ROWS_PER_TASK = 1_000_000
#: Parts over which rows without a key are spread.
SALTS = 64


def heaviest(counts: DataFrame, count: str = "count", rows_per_task: int | None = None) -> DataFrame:
    """The keys with more rows than a task takes."""
    return counts.where(F.col(count) > (rows_per_task or ROWS_PER_TASK))


def spread(key: Column, salts: int | Column = SALTS) -> Column:
    """A salt in [0, salts) for the rows of a key that is the same when a task is run again: rows of one input
    partition share it, and the partitions take turns. It reads no column but the key."""
    salts = F.lit(salts) if isinstance(salts, int) else salts
    return F.pmod(F.pmod(F.hash(key), salts) + F.spark_partition_id(), salts).cast("int")


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str, rows_per_task: int | None = None) -> DataFrame:
    """Equi-join for a left side with hot keys: a heavy key's rows are salted, as many salts as it has tasks' worth of
    rows, and its right rows repeated per salt.

    `how` is inner, left, left_semi or left_anti.  NULL keys never match, so they are only spread.
    """
    share = rows_per_task or ROWS_PER_TASK
    counts = left.where(_all_set(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__rows"))
    parts = F.ceil(F.col("__rows") / share).cast("int")
    heavy = F.broadcast(heaviest(counts, "__rows", share).select(*on, parts.alias("__parts")))
    key = F.struct(*on)
    salt = F.when(F.col("__parts").isNotNull(), spread(key, F.col("__parts"))).when(~_all_set(on), spread(key)).otherwise(0)
    salted_left = left.join(heavy, on, "left").withColumn("__salt", salt).drop("__parts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__parts"), F.lit(1)) - 1)
    salted_right = right.join(heavy, on, "left").withColumn("__salt", F.explode(copies)).drop("__parts")
    return salted_left.join(salted_right, [*on, "__salt"], how).drop("__salt")


def _all_set(columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).isNotNull()
    return condition


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by `order`, NULLs counting as oldest.

    ``row_number() = 1`` is planned with a group limit before the exchange, so each map task sends at
    most one row per key and a hot key costs no more than any other.
    """
    recent = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rank", F.row_number().over(recent)).where("__rank = 1").drop("__rank")
