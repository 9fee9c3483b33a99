from __future__ import annotations

import datetime as dt
import glob
import math
import os
import random

import pytest

from pactlake.contract import parse_product
from pactlake.operators.sla import (
    availability, expire_partitions, freshness_lag, quality_trend, row_count_bounds, unexpired,
)
from pactlake.sources.readers import read_table
from pactlake.sources.writers import write_table


def stamps(spark, *values, group="g"):
    return spark.createDataFrame([(group, v) for v in values], "k string, at string").selectExpr(
        "k", "CAST(at AS timestamp_ntz) AS at"
    )


def test_freshness_lag(spark):
    tables = {
        "fresh": (stamps(spark, "2024-01-01 10:00:00", "2024-01-01 11:59:01"), "at"),
        "stale": (stamps(spark, "2024-01-01 10:59:00"), "at"),
        "edge": (stamps(spark, "2024-01-01 11:00:00"), "at"),
        "empty": (stamps(spark, "2024-01-01").where("false"), "at"),
    }
    got = {r.table: (r.lag_minutes, r.breached) for r in freshness_lag(tables, "2024-01-01 12:00:00", 1).collect()}
    assert got == {"fresh": (0, False), "stale": (61, True), "edge": (60, False), "empty": (None, True)}
    second = {"over": (stamps(spark, "2024-01-01 10:59:59"), "at"), "half": (stamps(spark, "2024-01-01 11:40:00"), "at")}
    assert [r.breached for r in freshness_lag(second, "2024-01-01 12:00:00", 1).orderBy("table").collect()] == [False, True]
    assert [r.breached for r in freshness_lag(second, "2024-01-01 12:00:00", 0.5).orderBy("table").collect()] == [False, True]


def test_unexpired_keeps_the_bound_itself(spark):
    df = stamps(spark, "2024-01-01 00:00:00", "2023-12-31 23:59:59")
    assert unexpired(df, "at", "2024-01-08 00:00:00", 7).count() == 1


def test_row_count_bounds(spark):
    tables = {"a": spark.range(1), "b": spark.range(5)}
    assert {r.table: r.passed for r in row_count_bounds(tables, 2, None).collect()} == {"a": False, "b": True}
    assert {r.table: r.passed for r in row_count_bounds(tables, None, 4).collect()} == {"a": True, "b": False}


@pytest.mark.parametrize("start", [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 1, 1, 5, 7, 11)])
def test_availability_equals_brute_force(spark, start):
    rng = random.Random(3)
    moments = [start + dt.timedelta(minutes=rng.randrange(0, 60 * 48)) for _ in range(14)]
    df = stamps(spark, *[str(m) for m in moments], group="x").unionByName(stamps(spark, "2024-01-04 12:00:00", group="late"))
    for bound in (1, 3):
        got = availability(df, "k", "at", str(start), 48, bound, 50.0).where("k = 'x'").first()
        fresh = 0
        for h in range(48):
            end = start + dt.timedelta(hours=h + 1)
            seen = [m for m in moments if m < end]
            fresh += bool(seen) and end - max(seen) <= dt.timedelta(hours=bound)
        assert got.fresh_hours == fresh
        assert got.availability_pct == round(100 * fresh / 48, 4) and got.met == (fresh >= 24)
    late = availability(df, "k", "at", str(start), 48, 1, 0.0).where("k = 'late'").first()
    assert (late.hours, late.fresh_hours, late.met) == (48, 0, True)


def test_availability_from_half_past(spark):
    got = availability(stamps(spark, "2024-01-01 13:05:00"), "k", "at", "2024-01-01 12:30:00", 2, 2, 50.0).first()
    assert (got.fresh_hours, got.availability_pct, got.met) == (2, 100.0, True)


def test_availability_counts_what_arrived_before_and_silent_groups(spark):
    df = stamps(spark, "2023-12-31 23:55:00").unionByName(stamps(spark, "2024-01-05", group="later"))
    known = spark.createDataFrame([("never",), ("g",)], "k string")
    got = availability(df, "k", "at", "2024-01-01 00:00:00", 30, 24, 50.0, known).collect()
    assert {r.k: (r.hours, r.fresh_hours, r.met) for r in got} == {"g": (30, 23, True), "later": (30, 0, False), "never": (30, 0, False)}


def test_trend(spark):
    rows = [("2024-01-01", True), ("2024-01-01", False), ("2024-01-02", True), ("2024-01-02", True)]
    results = spark.createDataFrame(rows, "run_date string, passed boolean").selectExpr("'p' product", "'t' table", "*")
    got = {r.run_date: (r.pass_rate, r.change) for r in quality_trend(results).collect()}
    assert got["2024-01-02"] == (1.0, 0.5) and got["2024-01-01"][0] == 0.5 and got["2024-01-01"][1] is None
    assert not math.isnan(got["2024-01-02"][1])


def test_expired_partitions_are_dropped_by_name(spark, tmp_path, document):
    document["name"] = "expiring"
    document["sla"]["freshness_hours"] = 24
    document["tables"][0].update(partition_by=[{"column": "ts", "transform": "day"}])
    product = parse_product(document)
    days = [f"2024-01-{d:02d} 12:00:00" for d in range(1, 11)]
    df = stamps(spark, *days).selectExpr("7 AS event_id", "7 AS user_id", "'view' AS event_type", "at AS ts")
    write_table(df, product, "raw_events", str(tmp_path))
    folder = glob.glob(f"{product.location(str(tmp_path), 'raw_events')}/*/__p_ts_day=2024-01-01")[0]
    expire = lambda *args: {r.outcome: (r.periods, r.oldest, r.newest) for r in expire_partitions(spark, product, "raw_events", *args).collect()}
    # Seven days before the 10th at noon: the 3rd still has rows inside the bound.
    assert expire("2024-01-10 12:00:00") == {"dropped": (2, "2024-01-01", "2024-01-02"), "straddling": (1, "2024-01-03", "2024-01-03")}
    assert spark.table("expiring.raw_events").count() == 8 and os.path.isdir(folder)
    assert read_table(spark, product, "raw_events").count() == 8 and read_table(spark, product, "raw_events", version=1).count() == 10
    assert expire("2024-01-12 12:00:00", True)["dropped"] == (2, "2024-01-03", "2024-01-04")
    assert read_table(spark, product, "raw_events").count() == 6
    assert not os.path.exists(folder.replace("01-01", "01-03"))
    assert os.path.isdir(folder.replace("01-01", "01-05"))
