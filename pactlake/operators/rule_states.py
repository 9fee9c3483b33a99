"""A rule suite as states that can be added up.

What a suite needs to know of some rows is, for each check, how many it looked at, how many broke it and the newest time;
and for ``unique`` how often each value occurs. These of two sets of rows give those of both together, so a verdict over
a growing table or a stream follows from states that are kept, without the rows. `judged` makes of them what `run_suite`
makes of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlake.contract import Rule, Table
from pactlake.functions.expressions import hours, timestamp_literal
from pactlake.operators.quality import RESULT_COLUMNS, breaks, checks

STATE = "check int, evaluated long, failed long, newest timestamp_ntz"


def scanned_checks(table: Table) -> list[tuple[int, Rule, str]]:
    """The checks that counts and a newest time answer, each with its number among all checks."""
    return [(i, r, c) for i, (r, c) in enumerate(checks(table)) if r.kind != "unique"]


def unique_columns(table: Table) -> list[str]:
    return list(dict.fromkeys(c for r, c in checks(table) if r.kind == "unique"))


def rule_states(df: DataFrame, table: Table, *by: str) -> DataFrame:
    """One row per check other than ``unique`` (and per value of `by`), from a single pass over the rows."""
    aggregates, rows = [], []
    for i, rule, column in scanned_checks(table):
        every = rule.kind in ("not_null", "row_count_between")
        level = rule.kind in ("row_count_between", "freshness_hours")
        aggregates.append((F.count(F.lit(1)) if every else F.count(column)).alias(f"e{i}"))
        aggregates.append((F.lit(0).cast("long") if level else F.count_if(breaks(rule, column, table))).alias(f"f{i}"))
        newest = F.lit(None).cast("timestamp_ntz")
        if rule.kind == "freshness_hours":
            aggregates.append(F.max(column).cast("timestamp_ntz").alias(f"n{i}"))
            newest = F.col(f"n{i}")
        rows.append(
            F.struct(F.lit(i).alias("check"), F.col(f"e{i}").alias("evaluated"), F.col(f"f{i}").alias("failed"), newest.alias("newest"))
        )
    grouped = df.groupBy(*by)
    if not rows:
        none = F.from_json(F.lit("[]"), f"array<struct<{STATE.replace(' ', ':').replace(',:', ', ')}>>")
        return grouped.agg(F.count(F.lit(1)).alias("n")).select(*by, F.inline(none))
    return grouped.agg(*aggregates).select(*by, F.inline(F.array(*rows)))


def added_states(states: DataFrame, *by: str) -> DataFrame:
    """The states of several sets of rows together."""
    return states.groupBy(*by, "check").agg(
        F.sum("evaluated").alias("evaluated"), F.sum("failed").alias("failed"), F.max("newest").alias("newest")
    )


def value_counts(df: DataFrame, column: str, *by: str) -> DataFrame:
    """How often each value of a unique column occurs (per value of `by`); NULLs are not looked at."""
    return df.where(F.col(column).isNotNull()).groupBy(*by, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def added_counts(counts: DataFrame, *by: str) -> DataFrame:
    return counts.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def judged(states: DataFrame, values: dict[str, DataFrame], table: Table, product: str = "", as_of: str | None = None) -> DataFrame:
    """The results of the suite from `rule_states` and, by unique column, `value_counts`, of any sets of rows."""
    spark, every = states.sparkSession, checks(table)
    known = added_states(states)
    parts = [spark.range(len(every)).select(F.col("id").cast("int").alias("check")).join(F.broadcast(known), "check", "left")]
    parts[0] = parts[0].where(F.col("check").isin([i for i, _, _ in scanned_checks(table)]))
    evaluated = F.coalesce("evaluated", F.lit(0)).cast("long")
    failed = F.coalesce("failed", F.lit(0)).cast("long")
    for i, rule, _ in scanned_checks(table):
        if rule.kind == "row_count_between":
            failed = F.when(F.col("check") == i, _outside(evaluated, rule).cast("long")).otherwise(failed)
        elif rule.kind == "freshness_hours":
            if as_of is None:
                raise ValueError(f"{table.name}: freshness_hours needs as_of")
            stale = F.coalesce(F.col("newest") < timestamp_literal(as_of) - hours(rule.params["hours"]), F.lit(True))
            failed = F.when(F.col("check") == i, stale.cast("long")).otherwise(failed)
    parts[0] = parts[0].select("check", evaluated.alias("evaluated"), failed.alias("failed"))
    for i, (rule, column) in enumerate(every):
        if rule.kind == "unique":
            total = added_counts(values[column]).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failed")
            )
            parts.append(total.select(F.lit(i).alias("check"), "evaluated", "failed"))
    named = lambda text: F.element_at(F.array(*[F.lit(text(r, c)) for r, c in every]), F.col("check") + 1)
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(product).alias("product"), F.lit(table.name).alias("table"), F.lit(table.tier).alias("tier"),
        named(lambda r, c: r.kind).alias("rule_type"), named(lambda r, c: c).alias("column"),
        "evaluated", "failed", (F.col("failed") == 0).alias("passed"),
    ).select(*RESULT_COLUMNS)


def _outside(rows: Column, rule: Rule) -> Column:
    low, high = rule.params.get("min"), rule.params.get("max")
    outside = F.lit(False)
    if low is not None:
        outside |= rows < F.lit(low)
    if high is not None:
        outside |= rows > F.lit(high)
    return outside
