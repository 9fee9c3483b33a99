from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Rule, Table, parse_product
from pactlake.operators.layout import read_partitioned
from pactlake.operators.medallion import deduplicate, latest_state, segment, standardise, write_snapshot
from pactlake.plans.customers import customer_summary
from pactlake.plans.orders import order_facts
from pactlake.plans.tiers import run_product


def test_deduplicate_is_deterministic_under_ties(spark):
    rows = [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (1, "2024-01-02", "c"), (2, None, "d"), (2, None, "e")]
    for partitions in (1, 4):
        df = spark.createDataFrame(rows, "k long, at string, x string").repartition(partitions)
        got = {r.k: r.x for r in deduplicate(df, ["k"], ["at"]).collect()}
        assert got == {1: "c", 2: "e"}


def test_deduplicate_limits_each_key_before_the_shuffle(spark):
    text = plan(deduplicate(spark.range(10).selectExpr("id % 2 AS k", "id AS at"), ["k"], ["at"]))
    before_exchange = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_latest_state_prefers_the_later_sequence(spark):
    df = spark.createDataFrame([(1, 5, 1, "old"), (1, 5, 2, "new"), (1, None, 9, "undated")], "k int, at int, n int, s string")
    assert [r.s for r in latest_state(df, ["k"], "at", "n").collect()] == ["new"]


def test_standardise(spark):
    table = Table(
        "t", "silver", (Column("id", "string", False), Column("code", "string"), Column("n", "integer")),
        rules=(Rule("not_null", ("id",)),),
    )
    raw = spark.createDataFrame([(" a ", " us", "1"), ("  ", "de", "x"), ("b", "", None)], "id string, code string, n string")
    good, bad = standardise(raw, table, codes=("code",))
    assert {(r.id, r.code, r.n) for r in good.collect()} == {("a", "US", 1), ("b", None, None)}
    assert [(r.code, r.broken_rules) for r in bad.collect()] == [("DE", ["not_null:id"])]


@pytest.mark.parametrize(
    "spend, first, last, expected",
    [
        (0, None, None, "churned"),
        (9_000_000, "2020-01-01", "2022-12-31", "churned"),
        (9_000_000, "2023-01-01", "2023-01-01", "new"),
        (3_000_000, "2020-01-01", "2023-01-01", "high_value"),
        (2_999_999, "2020-01-01", "2023-06-01", "mid_value"),
        (1_500_000, "2022-12-31", "2023-06-01", "mid_value"),
        (1_499_999, "2020-01-01", "2023-06-01", "low_value"),
    ],
)
def test_segments(spark, spend, first, last, expected):
    at = lambda v: F.lit(v).cast("timestamp_ntz")
    row = spark.range(1).select(segment(F.lit(spend), at(first), at(last), at("2024-01-01")).alias("s")).first()
    assert row.s == expected


def test_customer_summary_keeps_customers_without_orders_and_ignores_the_future(spark):
    customers = spark.createDataFrame([("1", "A", "US"), ("2", "B", "DE")], "customer_id string, full_name string, country_code string")
    orders = spark.createDataFrame(
        [("1", "10.10", "2024-01-01"), ("1", "5.05", "2024-02-01"), ("1", "99", "2024-03-02"), (None, "1", "2024-01-01")],
        "customer_id string, total string, created_at string",
    ).selectExpr("customer_id", "CAST(total AS decimal(18,2)) total", "CAST(created_at AS timestamp_ntz) created_at")
    got = {r.customer_id: r for r in customer_summary(customers, orders, "2024-03-01").collect()}
    assert (got["1"].total_orders, got["1"].total_spend) == (2, Decimal("15.15"))
    assert got["1"].last_order_at == dt.datetime(2024, 2, 1)
    assert (got["2"].total_orders, got["2"].total_spend, got["2"].customer_segment) == (0, Decimal("0.00"), "churned")
    assert got["1"].as_of_date == dt.date(2024, 3, 1)


def test_order_facts_round_once_at_the_end(spark):
    orders = spark.sql(
        "SELECT * FROM VALUES (1L, 'c', 'F', TIMESTAMP_NTZ '2024-01-01'), (2L, 'c', 'X', TIMESTAMP_NTZ '2024-01-01')"
        " AS t(order_id, customer_id, status, created_at)"
    )
    lines = spark.sql(
        "SELECT order_id, CAST(p AS decimal(12,2)) price, CAST(d AS decimal(4,2)) discount, CAST(t AS decimal(4,2)) tax,"
        " TIMESTAMP_NTZ '2024-01-05' changed_at FROM VALUES (1L, 0.05, 0.10, 0.10), (1L, 0.05, 0.10, 0.10) AS v(order_id, p, d, t)"
    )
    got = {r.order_id: r for r in order_facts(orders, lines).collect()}
    assert (got[1].item_count, got[1].subtotal, got[1].tax, got[1].total) == (
        2, Decimal("0.09"), Decimal("0.01"), Decimal("0.10"),
    )
    assert got[1].status == "delivered" and got[1].updated_at == dt.datetime(2024, 1, 5)
    assert (got[2].item_count, got[2].total, got[2].status) == (0, Decimal("0.00"), "x")
    assert got[2].updated_at == dt.datetime(2024, 1, 1)


def test_snapshot_replaces_its_month_only(spark, tmp_path):
    table = Table(
        "s", "gold", (Column("id", "long", False), Column("as_of_date", "date", False)),
        partitions=(Partition("as_of_date", "month"),),
    )
    at = lambda day, n: spark.range(n).selectExpr("id", f"DATE '{day}' AS as_of_date")
    for day, n in (("2024-01-31", 3), ("2024-02-15", 9), ("2024-02-29", 4)):
        write_snapshot(at(day, n), table, str(tmp_path / "s"))
    stored = read_partitioned(spark, table, str(tmp_path / "s"))
    assert {(str(r.as_of_date), r["count"]) for r in stored.groupBy("as_of_date").count().collect()} == {
        ("2024-01-31", 3), ("2024-02-29", 4),
    }


def test_blocked_tables_are_not_built_and_the_rest_is(spark, tmp_path, document):
    schema = [{"name": "id", "type": "long", "nullable": False}]
    document["name"] = "gated"
    rule = [{"not_null": ["id"]}, {"unique": ["id"]}]
    document["tables"] = [
        {"name": "g", "tier": "gold", "schema": schema, "inputs": ["s"]},
        {"name": "s", "tier": "silver", "schema": schema, "inputs": ["bad"]},
        {"name": "s2", "tier": "silver", "schema": schema, "inputs": ["good"], "quality_rules": rule},
        {"name": "bad", "tier": "bronze", "schema": schema, "quality_rules": rule},
        {"name": "good", "tier": "bronze", "schema": schema, "quality_rules": rule},
    ]
    never = lambda _: pytest.fail("built although its input failed")
    builds = {
        "bad": lambda _: spark.range(3).selectExpr("id % 2 AS id"),
        "good": lambda _: spark.range(3).toDF("id"),
        "s": never,
        "g": never,
        "s2": lambda t: t["good"].where("id > 0"),
    }
    out = run_product(spark, parse_product(document), builds, str(tmp_path), "2024-01-01 00:00:00")
    got = {r.table: (r.status, r.rows, r.failed_rules) for r in out.collect()}
    assert got == {
        "bad": ("failed", 3, 1), "good": ("passed", 3, 0), "s": ("blocked", 0, 0), "g": ("blocked", 0, 0),
        "s2": ("passed", 2, 0),
    }
    results = spark.read.parquet(f"{tmp_path}/gated/_results")
    assert results.count() == 6 and results.where("not passed").count() == 1
