"""Freshness, retention, row counts, availability and the trend of validation runs.

Each takes the moment of measurement as ``as_of``; nothing reads a clock.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactlake.contract import Product
from pactlake.functions.expressions import hours as hours_interval
from pactlake.functions.expressions import minutes_between, timestamp_literal
from pactlake.session import materialize
from pactlake.sources.versions import LAYER, NULL, without_partitions
from pactlake.sources.writers import sync_partitions, versions_of

PERIOD_PATTERNS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}
MICROS_PER_HOUR = 3_600_000_000


def freshness_lag(tables: dict[str, tuple[DataFrame, str]], as_of: str, freshness_hours: float) -> DataFrame:
    """whole minutes since the newest row of each table, and whether its age exceeds the promise.

    `tables` maps a name to (rows, timestamp column). The breach is of the exact age, a second over the promise
    being over it. An empty table is a breach.
    """
    newest = [
        df.agg(F.max(at).alias("newest")).select(F.lit(name).alias("table"), "newest")
        for name, (df, at) in tables.items()
    ]
    lag = minutes_between(timestamp_literal(as_of), F.col("newest"))
    return reduce(DataFrame.unionByName, newest).select(
        "table",
        "newest",
        lag.alias("lag_minutes"),
        F.coalesce(F.col("newest") < timestamp_literal(as_of) - hours_interval(freshness_hours), F.lit(True)).alias("breached"),
    )


def unexpired(df: DataFrame, at: str, as_of: str, days: int) -> DataFrame:
    """rows no older than `days` days."""
    return df.where(F.col(at) >= timestamp_literal(as_of) - F.make_dt_interval(days=F.lit(days)))


def expire_partitions(
    spark: SparkSession, product: Product, table: str, as_of: str, delete_files: bool = False
) -> DataFrame:
    """take out the day, hour, month or year partitions that lie wholly before the retention bound.

    One row per outcome: `dropped`, the periods that are gone, and `straddling`, those with rows on both sides of the
    bound, which stay until all of them are too old; each with `periods` and the `oldest` and `newest` of them. Works on
    partition names alone, no data file is read. The next version of the table is without them, in one step. Earlier versions have
    their files until they expire, unless `delete_files` is set.
    """
    spec = next(p for p in product.table(table).partitions if p.transform in PERIOD_PATTERNS)
    bound = F.date_format(timestamp_literal(as_of) - F.make_dt_interval(days=F.lit(product.bronze_retention_days)), PERIOD_PATTERNS[spec.transform])
    value = F.regexp_extract("partition", f"{spec.field_name}=([^/]*)", 1)
    names = spark.sql(f"SHOW PARTITIONS {product.fqn(table)}").where((value != NULL) & (value <= bound))
    names = names.select("partition", value.alias("period"), F.when(value < bound, "dropped").otherwise("straddling").alias("outcome"))
    counted = names.groupBy("outcome").agg(F.count_distinct("period").alias("periods"), F.min("period").alias("oldest"), F.max("period").alias("newest"))
    outcome = materialize(counted, "expired")
    # Catalog metadata, not data: one short string per period and layer.
    gone = [row.partition.partition("/")[2] for row in names.where("outcome = 'dropped'").select("partition").toLocalIterator()]
    folder = versions_of(spark, product, table)
    before = folder.commit("expire", lambda now: replace(now, layers=without_partitions(now, gone)) if gone else None)
    if delete_files:
        for layer in before.layers:
            for path in gone:
                folder.delete(f"{LAYER}={layer.name}/{path}")
    sync_partitions(spark, product, table)
    return outcome


def row_count_bounds(tables: dict[str, DataFrame], low: int | None, high: int | None) -> DataFrame:
    """rows per table against the promised bounds; a missing bound does not bind."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table", F.lit(n)) for n, df in tables.items()]
    within = F.lit(True)
    if low is not None:
        within &= F.col("row_count") >= low
    if high is not None:
        within &= F.col("row_count") <= high
    return reduce(DataFrame.unionByName, counts).select("table", "row_count", within.alias("passed"))


def availability(
    df: DataFrame, group: str, at: str, start: str, hours: int, freshness_hours: float, target_pct: float,
    groups: DataFrame | None = None,
) -> DataFrame:
    """share of the hours from `start` at whose end the newest row was within the freshness bound.

    Every group of `df` is reported, and every one that `groups` lists, a silent one with no fresh hour. What arrived
    before `start` counts as long as it is fresh.

    Hours are counted from `start`, whatever minute that is. Rows are first reduced to the newest one per group and hour,
    all earlier ones to the first hour. Between one such arrival and the next the data only ages, so the hours it keeps
    fresh can be counted without laying out every hour: what arrived s after `start` is fresh, from hour h on, at the
    ends of the first floor((s + bound) / 1 h) - h hours, until the hour of the next arrival. The window sees at most
    `hours` rows per group.
    """
    first = timestamp_literal(start)
    end = first + F.make_dt_interval(hours=F.lit(hours))
    since = lambda c: F.timestamp_diff("MICROSECOND", first, c)
    hour = F.floor(F.greatest(since(F.col(at)), F.lit(0)) / F.lit(MICROS_PER_HOUR))
    arrivals = df.groupBy(group, F.when(F.col(at) < end, hour).alias("hour")).agg(F.max(at).alias("newest"))
    following = F.lead("hour").over(Window.partitionBy(group).orderBy(F.col("hour").asc_nulls_first()))
    reach = F.floor((since(F.col("newest")) + F.lit(round(freshness_hours * MICROS_PER_HOUR))) / F.lit(MICROS_PER_HOUR))
    until = F.coalesce(following, F.lit(hours))
    # A row without an hour only says that the group is there.
    fresh = F.when(F.col("hour").isNull(), 0).otherwise(F.greatest(F.lit(0), F.least(reach, until) - F.col("hour")))
    counted = arrivals.select(group, fresh.alias("fresh"))
    if groups is not None:
        counted = counted.union(groups.select(group, F.lit(0).alias("fresh")))
    share = F.round(F.lit(100.0) * F.col("fresh_hours") / F.col("hours"), 4)
    return (
        counted.groupBy(group)
        .agg(F.lit(hours).cast("long").alias("hours"), F.sum("fresh").alias("fresh_hours"))
        .select(group, "hours", "fresh_hours", share.alias("availability_pct"), (share >= target_pct).alias("met"))
    )


def quality_trend(results: DataFrame) -> DataFrame:
    """pass rate per table and run, and the change since the run before.

    The window sees one row per run of a table, the results having been aggregated first.
    """
    runs = results.groupBy("product", "table", "run_date").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed_checks")
    )
    rate = F.round(F.col("passed_checks") / F.col("checks"), 6)
    before = F.lag(rate).over(Window.partitionBy("product", "table").orderBy("run_date"))
    return runs.select(
        "product", "table", "run_date", "checks", "passed_checks",
        rate.alias("pass_rate"), F.round(rate - before, 6).alias("change"),
    )
