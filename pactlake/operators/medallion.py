"""The generic steps between bronze, silver and gold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Table
from pactlake.functions.expressions import blank_to_null
from pactlake.functions.skew import latest_per_key
from pactlake.operators.layout import write_partitioned
from pactlake.operators.quality import BROKEN, mark_broken
from pactlake.operators.schema import conform

# Segment limits, in the currency of the orders, and the activity period.
HIGH_SPEND = 3_000_000
MID_SPEND = 1_500_000
ACTIVE_DAYS = 365


def deduplicate(df: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """One row per key, the latest wins; ties are broken by all other columns, so the result is fixed."""
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    return latest_per_key(df, keys, latest_by + rest)


def latest_state(log: DataFrame, keys: list[str], at: str, sequence: str) -> DataFrame:
    """The newest row of each entity in an event log."""
    return latest_per_key(log, keys, [at, sequence])


def standardise(df: DataFrame, table: Table, codes: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Trimmed strings, blanks as NULL, upper-case codes, declared types; (valid rows, rejected rows).

    Two views of one marked plan; to store both, store `standardise_marked` once.
    """
    marked = standardise_marked(df, table, codes)
    return marked.where(F.size(BROKEN) == 0).drop(BROKEN), marked.where(F.size(BROKEN) > 0)


def standardise_marked(df: DataFrame, table: Table, codes: tuple[str, ...] = ()) -> DataFrame:
    """The standardised rows, each with the rules it breaks."""
    cleaned = {
        f.name: F.upper(blank_to_null(F.col(f.name))) if f.name in codes else blank_to_null(F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, T.StringType)
    }
    return mark_broken(conform(df.withColumns(cleaned), table), table)


def segment(spend: Column, first_at: Column, last_at: Column, as_of: Column) -> Column:
    """E5: churned without a recent order, new with a recent first one, otherwise by spend."""
    since = as_of - F.make_dt_interval(days=F.lit(ACTIVE_DAYS))
    return (
        F.when(last_at.isNull() | (last_at < since), "churned")
        .when(first_at >= since, "new")
        .when(spend >= HIGH_SPEND, "high_value")
        .when(spend >= MID_SPEND, "mid_value")
        .otherwise("low_value")
    )


def write_snapshot(df: DataFrame, table: Table, location: str) -> None:
    """Replace the snapshot partitions `df` has rows for, keep the others."""
    write_partitioned(conform(df, table), table, location, mode="overwrite")
