from __future__ import annotations

import math
import re

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import Column, Rule, Table
from pactlake.operators.quality import BROKEN, gate, mark_broken, quarantine, run_suite, verdict

COLUMNS = (
    Column("id", "long"), Column("email", "string"), Column("code", "string"), Column("v", "double"),
    Column("at", "timestamp"),
)


def table(*rules: Rule) -> Table:
    return Table("t", "silver", COLUMNS, rules=rules)


def rows(spark, *values):
    padded = [v + (None,) * (4 - len(v)) for v in values]
    return spark.createDataFrame(padded, "id long, email string, code string, v double").withColumn(
        "at", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")
    )


def results(df, *rules, as_of=None):
    return {(r.rule_type, r.column): (r.evaluated, r.failed) for r in run_suite(df, table(*rules), "p", as_of).collect()}


def test_not_null_and_unique(spark):
    df = rows(spark, (1,), (1,), (2,), (None,), (None,))
    assert results(df, Rule("not_null", ("id",)), Rule("unique", ("id",))) == {
        ("not_null", "id"): (5, 2),
        ("unique", "id"): (3, 2),  # both rows of the repeated value; NULLs are not values
    }


def test_one_check_per_column(spark):
    df = rows(spark, (1, "a"), (2, "a"))
    assert results(df, Rule("unique", ("id", "email"))) == {("unique", "id"): (2, 0), ("unique", "email"): (2, 2)}


@pytest.mark.parametrize(
    "email, ok",
    [
        ("a@b.co", True), ("first.last+tag%x_y-z@sub.example-1.org", True), ("a@b", False), ("a@b.c", False),
        ("@b.co", False), ("a b@c.co", False), ("a@b.co\n", False), ("a@b.c0", False), ("ä@b.co", False),
    ],
)
def test_email(spark, email, ok):
    assert results(rows(spark, (1, email)), Rule("email_format", ("email",)))[("email_format", "email")] == (1, int(not ok))


def test_null_passes_everything_but_not_null(spark):
    rules = (
        Rule("email_format", ("email",)), Rule("regex", ("code",), {"pattern": "^a"}),
        Rule("accepted_values", ("code",), {"values": ["a"]}), Rule("min_value", ("v",), {"min": 0}),
        Rule("max_value", ("v",), {"max": 0}),
    )
    assert set(results(rows(spark, (1,)), *rules).values()) == {(0, 0)}


def test_regex_finds_anywhere(spark):
    df = rows(spark, (1, None, "xax"), (2, None, "b"))
    assert results(df, Rule("regex", ("code",), {"pattern": "a"}))[("regex", "code")] == (2, 1)


def test_bounds_are_inclusive_and_nan_is_large(spark):
    df = rows(spark, (1, None, None, 0.0), (2, None, None, 10.0), (3, None, None, math.nan), (4, None, None, -0.1))
    got = results(df, Rule("min_value", ("v",), {"min": 0}), Rule("max_value", ("v",), {"max": 10}))
    assert got == {("min_value", "v"): (4, 1), ("max_value", "v"): (4, 1)}


def test_accepted_values_take_the_column_type(spark):
    df = rows(spark, (1,), (2,), (3,))
    assert results(df, Rule("accepted_values", ("id",), {"values": ["1", 2]}))[("accepted_values", "id")] == (3, 1)


@pytest.mark.parametrize("values, failed", [(["1", "x"], 2), (["x"], 3), ([], 3), ([1.0, 2], 2)])
def test_values_that_do_not_fit_the_type_match_nothing(spark, values, failed):
    df = rows(spark, (1,), (3,), (4,), (None,))
    assert results(df, Rule("accepted_values", ("id",), {"values": values}))[("accepted_values", "id")] == (3, failed)


def test_accepted_text_with_quotes(spark):
    df = rows(spark, (1, None, "it's"), (2, None, "a\\b"), (3, None, "plain"))
    rule = Rule("accepted_values", ("code",), {"values": ["it's", "a\\b"]})
    assert results(df, rule)[("accepted_values", "code")] == (3, 1)


def test_number_bound_on_text(spark):
    df = rows(spark, (1, None, "5"), (2, None, "x"), (3, None, "-1"))
    assert results(df, Rule("min_value", ("code",), {"min": 0}))[("min_value", "code")] == (3, 1)


def test_long_value_list(spark):
    df = spark.range(3000).select("id")
    values = list(range(2500))
    assert results(df, Rule("accepted_values", ("id",), {"values": values}))[("accepted_values", "id")] == (3000, 500)


@pytest.mark.parametrize("params, failed", [({"min": 3}, 1), ({"max": 1}, 1), ({"min": 2, "max": 2}, 0)])
def test_row_count(spark, params, failed):
    df = rows(spark, (1,), (2,))
    assert results(df, Rule("row_count_between", (), params))[("row_count_between", "")] == (2, failed)


@pytest.mark.parametrize("as_of, failed", [("2024-01-02 12:00:00", 0), ("2024-01-02 12:00:01", 1)])
def test_freshness_bound_is_inclusive(spark, as_of, failed):
    got = results(rows(spark, (1,)), Rule("freshness_hours", ("at",), {"hours": 24}), as_of=as_of)
    assert got[("freshness_hours", "at")] == (1, failed)


def test_freshness_needs_a_moment(spark):
    with pytest.raises(ValueError, match="as_of"):
        run_suite(rows(spark, (1,)), table(Rule("freshness_hours", ("at",), {"hours": 24})))


def test_empty_table(spark):
    df = rows(spark, (1,)).where("false")
    got = results(
        df, Rule("not_null", ("id",)), Rule("unique", ("id",)), Rule("row_count_between", (), {"min": 1}),
        Rule("freshness_hours", ("at",), {"hours": 1}), as_of="2024-01-01",
    )
    assert got == {
        ("not_null", "id"): (0, 0), ("unique", "id"): (0, 0), ("row_count_between", ""): (0, 1),
        ("freshness_hours", "at"): (0, 1),
    }


def test_suite_scans_once_for_all_but_unique(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, (1, "a@b.co", "a", 1.0)).write.parquet(path)
    stored = spark.read.parquet(path)
    rules = (
        Rule("not_null", ("id", "email")), Rule("email_format", ("email",)), Rule("min_value", ("v",), {"min": 0}),
        Rule("row_count_between", (), {"min": 1}),
    )
    assert plan(run_suite(stored, table(*rules))).count("FileScan") == 1
    with_unique = plan(run_suite(stored, table(*rules, Rule("unique", ("id",)))))
    assert with_unique.count("FileScan") == 2
    assert "ReadSchema: struct<id:bigint>" in with_unique


def test_marks_name_every_broken_rule(spark):
    df = rows(spark, (1, "bad", "a", -1.0), (1, "x@y.zz", "a", 1.0), (2, None, None, None), (None, None, "b", 0.0))
    rules = (
        Rule("not_null", ("id",)), Rule("unique", ("id",)), Rule("email_format", ("email",)),
        Rule("accepted_values", ("code",), {"values": ["a"]}), Rule("min_value", ("v",), {"min": 0}),
        Rule("row_count_between", (), {"min": 1}),
    )
    got = sorted((tuple(sorted(r[BROKEN])) for r in mark_broken(df, table(*rules)).collect()))
    assert got == sorted(
        [
            ("email_format:email", "min_value:v", "unique:id"), ("unique:id",), (),
            ("accepted_values:code", "not_null:id"),
        ]
    )


def test_quarantine_keeps_every_row_once(spark):
    df = rows(spark, (1, "a@b.co"), (1, "a@b.co"), (1, "a@b.co"), (2, "x"), (3, "c@d.ee"))
    good, bad = quarantine(df, table(Rule("unique", ("id",)), Rule("email_format", ("email",))))
    assert [r.id for r in good.collect()] == [3]
    assert sorted(r.id for r in bad.collect()) == [1, 1, 1, 2]


def test_marks_with_more_repeated_keys_than_are_broadcast(spark, monkeypatch):
    """Repeated keys beyond the broadcast ones take the shuffle; the answer does not change."""
    from pactlake.operators import quality

    real = quality.heaviest
    monkeypatch.setattr(quality, "heaviest", lambda counts, count: real(counts, count, 2))
    # Key 0 owns a third of the rows, keys 1..49 two rows each, NULLs another third, the rest one.
    values = [(0,)] * 100 + [(k,) for k in range(1, 50)] * 2 + [(None,)] * 100 + [(k,) for k in range(1000, 1010)]
    df = spark.createDataFrame(values, "id long").repartition(4)
    _, bad = quarantine(df, table(Rule("unique", ("id",))))
    counted = {r.id: r["count"] for r in bad.groupBy("id").count().collect()}
    assert counted == {0: 100, **{k: 2 for k in range(1, 50)}}


def test_hot_rows_are_shuffled_by_key_and_salt(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(mark_broken(rows(spark, (1,), (1,), (2,)), table(Rule("unique", ("id",)))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (\w+)#", text)
    assert keys == [("id", "__salt"), ("id", "__salt")]


def test_table_without_row_rules(spark):
    good, bad = quarantine(rows(spark, (1,)), table(Rule("row_count_between", (), {"min": 1})))
    assert good.count() == 1 and bad.isEmpty()


def test_verdict_and_gate(spark):
    ok = run_suite(rows(spark, (1,)), table(Rule("not_null", ("id",))), "p")
    assert gate(ok)
    failed = run_suite(rows(spark, (None,)), table(Rule("not_null", ("id",))), "p")
    assert not gate(ok.unionByName(failed))
    total = verdict(ok.unionByName(failed)).where("tier is null").first()
    assert (total.rules, total.failed_rules, total.passed) == (2, 1, False)
