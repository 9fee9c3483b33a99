"""The nine rule kinds, the shared-scan suite, row quarantine and the verdict.

Meaning of the rules:

* a rule over several columns is one check per column, so ``unique: [a, b]`` is two checks;
* NULL breaks only ``not_null``; ``evaluated`` counts the rows a check looked at;
* NaN compares greater than every number;
* ``unique`` fails every row whose value occurs more than once;
* ``regex`` looks for a match anywhere, anchors are the author's;
* table-level rules fail at most once; an empty table is not fresh;
* "now" is always the argument ``as_of``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlake.contract import TABLE_LEVEL_RULES, Rule, Table
from pactlake.functions.expressions import hours, is_email, is_one_of, timestamp_literal
from pactlake.functions.skew import heaviest, spread
from pactlake.operators.schema import column_type
from pactlake.session import materialize

RESULT_COLUMNS = ["product", "table", "tier", "rule_type", "column", "evaluated", "failed", "passed"]
BROKEN = "broken_rules"


def breaks(rule: Rule, column: str, table: Table) -> Column:
    """True for a row that breaks a row-level rule, NULL or false otherwise."""
    value = F.col(column)
    declared = {c.name: column_type(c).simpleString() for c in table.columns}.get(column)
    match rule.kind:
        case "not_null":
            return value.isNull()
        case "email_format":
            return ~is_email(value)
        case "regex":
            return ~value.rlike(rule.params["pattern"])
        case "accepted_values":
            return value.isNotNull() & ~is_one_of(column, rule.params["values"], declared)
        case "min_value":
            return _ordered(value, rule.params["min"], declared) < F.lit(rule.params["min"])
        case "max_value":
            return _ordered(value, rule.params["max"], declared) > F.lit(rule.params["max"])
    raise ValueError(f"{rule.kind} is not a row-level rule")


def _ordered(value: Column, bound: object, declared: str | None) -> Column:
    """Text against a number is compared as a number; what is none passes, as a NULL does."""
    return value.try_cast("double") if declared == "string" and not isinstance(bound, str) else value


def checks(table: Table) -> list[tuple[Rule, str]]:
    """Every (rule, column) pair of a table; row counts have no column."""
    return [(r, c) for r in table.rules for c in (r.columns or ("",))]


def _scanned(rule: Rule, column: str, table: Table, as_of: str | None) -> tuple[Column, Column]:
    """(evaluated, failed) aggregates of a check that one pass over the rows can answer."""
    if rule.kind == "row_count_between":
        rows, low, high = F.count(F.lit(1)), rule.params.get("min"), rule.params.get("max")
        outside = F.lit(False)
        if low is not None:
            outside |= rows < F.lit(low)
        if high is not None:
            outside |= rows > F.lit(high)
        return rows, outside.cast("long")
    if rule.kind == "freshness_hours":
        if as_of is None:
            raise ValueError(f"{table.name}: freshness_hours needs as_of")
        bound = timestamp_literal(as_of) - hours(rule.params["hours"])
        return F.count(column), F.coalesce(F.max(column) < bound, F.lit(True)).cast("long")
    evaluated = F.count(F.lit(1)) if rule.kind == "not_null" else F.count(column)
    return evaluated, F.count_if(breaks(rule, column, table))


def _result(rule: Rule, column: str, evaluated: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.kind).alias("rule_type"),
        F.lit(column).alias("column"),
        evaluated.cast("long").alias("evaluated"),
        failed.cast("long").alias("failed"),
    )


def unique_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value, pre-aggregated before the shuffle."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__rows"))


def run_suite(df: DataFrame, table: Table, product: str = "", as_of: str | None = None) -> DataFrame:
    """One result row per check.

    Every check but ``unique`` is an aggregate of the same single pass; each ``unique`` column adds
    one grouping that reads that column only.
    """
    parts: list[DataFrame] = []
    scanned = [(r, c) for r, c in checks(table) if r.kind != "unique"]
    if scanned:
        aggregates = []
        for i, (rule, column) in enumerate(scanned):
            evaluated, failed = _scanned(rule, column, table, as_of)
            aggregates += [evaluated.alias(f"e{i}"), failed.alias(f"f{i}")]
        rows = [_result(r, c, F.col(f"e{i}"), F.col(f"f{i}")) for i, (r, c) in enumerate(scanned)]
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    for rule, column in checks(table):
        if rule.kind == "unique":
            totals = unique_counts(df, column).agg(
                F.coalesce(F.sum("__rows"), F.lit(0)).alias("e"),
                F.coalesce(F.sum(F.when(F.col("__rows") > 1, F.col("__rows"))), F.lit(0)).alias("f"),
            )
            parts.append(totals.select(F.inline(F.array(_result(rule, column, F.col("e"), F.col("f"))))))
    if not parts:
        raise ValueError(f"{table.name} declares no rules")
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(product).alias("product"),
        F.lit(table.name).alias("table"),
        F.lit(table.tier).alias("tier"),
        "rule_type", "column", "evaluated", "failed",
        (F.col("failed") == 0).alias("passed"),
    )


def mark_broken(df: DataFrame, table: Table) -> DataFrame:
    """Every row with the array of the row-level rules it breaks, as ``kind:column``.

    The repeated values of a unique column are counted first, from that column alone, and stored. Their
    size being known then, the planner broadcasts them when they are few, as they are in sound data, and
    the rows are marked without a shuffle. Where they are many, those above a task's share of rows are
    broadcast all the same, and the shuffle that finds the others leaves out those hot rows and the NULLs.
    """
    row_level = [(r, c) for r, c in checks(table) if r.kind not in ("unique", *TABLE_LEVEL_RULES)]
    marks = [F.when(breaks(r, c, table), F.lit(f"{r.kind}:{c}")) for r, c in row_level]
    out, payload = df, df.columns
    for i, column in enumerate(dict.fromkeys(c for r, c in checks(table) if r.kind == "unique")):
        out = _flag_repeated(out, df, column, f"__dup{i}")
        marks.append(F.when(F.col(f"__dup{i}"), F.lit(f"unique:{column}")))
    broken = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return out.select(*payload, broken.alias(BROKEN))


def _flag_repeated(rows: DataFrame, source: DataFrame, column: str, flag: str) -> DataFrame:
    repeated = materialize(unique_counts(source, column).where("__rows > 1"), "repeated")
    heavy = heaviest(repeated, "__rows").select(column, F.lit(True).alias("__heavy"))
    # Zero, but not a literal: a constant would be taken out of the join keys and the salt be lost.
    rest = repeated.select(column, F.pmod("__rows", F.lit(1)).cast("int").alias("__salt"), F.lit(True).alias("__found"))
    aside = F.col("__heavy") | F.col(column).isNull()
    return (
        rows.join(F.broadcast(heavy), column, "left")
        .withColumn("__salt", F.when(aside, F.lit(1) + spread(F.col(column))).otherwise(0))
        .join(rest, [column, "__salt"], "left")
        .withColumn(flag, F.coalesce("__heavy", "__found", F.lit(False)))
        .drop("__heavy", "__salt", "__found")
    )


def quarantine(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with their broken rules).

    Two views of one marked plan. To store both, write `mark_broken` once instead
    (`sources.writers.write_quarantine`).
    """
    marked = mark_broken(df, table)
    return marked.where(F.size(BROKEN) == 0).drop(BROKEN), marked.where(F.size(BROKEN) > 0)


def verdict(results: DataFrame) -> DataFrame:
    """Rules and failed rules per table, tier and overall (NULL marks a subtotal)."""
    return results.rollup("tier", "table").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(~F.col("passed")).alias("failed_rules"),
        F.bool_and("passed").alias("passed"),
    )


def gate(results: DataFrame) -> bool:
    """True when every check passed. Reads the result rows, one per check."""
    return results.where(~F.col("passed")).isEmpty()
