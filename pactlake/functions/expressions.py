"""Scalar expressions shared by the operators; all are built-in functions."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactlake.contract import EMAIL_PATTERN

# `$` also matches before a closing newline in Java, `\z` does not.
JAVA_EMAIL_PATTERN = EMAIL_PATTERN[:-1] + r"\z"


def is_email(c: Column) -> Column:
    return c.rlike(JAVA_EMAIL_PATTERN)


def display_name(c: Column) -> Column:
    """``raw_2fa_log`` -> ``Raw 2Fa Log``: a letter after anything but a letter is a capital."""
    words = F.split(F.lower(F.replace(c, F.lit("_"), F.lit(" "))), "(?<=[^a-z])(?=[a-z])")
    capital = lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))), w.substr(F.lit(2), F.length(w)))
    return F.array_join(F.transform(words, capital), "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def timestamp_literal(value: str | date | datetime) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def hours(value: float) -> Column:
    """An interval of hours, to the microsecond."""
    return F.make_dt_interval(secs=F.lit((Decimal(str(value)) * 3600).quantize(Decimal("0.000001"))))


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_one_of(column: str, values: list[Any], data_type: str | None) -> Column:
    """Whether a column holds one of the listed values, read as the column's type; never NULL.

    One expression whatever the length of the list; Catalyst turns a long list into a hash set. A value
    that does not fit the type matches nothing, nor does a NULL in the list.
    """
    typed = [_as_type(v, data_type) for v in values if v is not None]
    if not typed:
        return F.lit(False)
    return F.coalesce(F.expr(f"`{column}` IN ({', '.join(typed)})"), F.lit(False))


def _as_type(value: Any, data_type: str | None) -> str:
    """SQL of a listed value: text is read as the column's type, numbers compare as numbers."""
    if data_type != "string" and isinstance(value, (int, float)):
        return str(value).lower()
    text = sql_text(str(value).lower() if isinstance(value, bool) else str(value))
    return text if data_type in (None, "string") else f"try_cast({text} AS {data_type})"


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MINUTE", earlier, later)
