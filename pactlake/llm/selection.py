"""The k largest of any number of rows, without ordering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 16


def _ranked(value: Column) -> Column:
    """A double as a long of the same order, from the digits that conv gives of its bits."""
    whole = F.floor(value * float(1 << 20)).cast("decimal(38,0)")
    return F.least(F.greatest(whole + F.lit(1 << 62).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")


def mark_largest(rows: DataFrame, value: str, ties: str, k: int, mark: str) -> DataFrame:
    """`rows` with a boolean `mark`: whether a row is among the k with the largest `value`, the smaller `ties` first
    among equals. Rows with a null value are never among them.

    The k-th value is found digit by digit: each of four passes counts rows by the next 16 bits of the value (in steps of
    2**-20), so at most 65,536 counts come to the driver. Rows equal to the k-th value in all digits are ordered among
    themselves.
    """
    ranked = rows.withColumn("__rank", F.when(F.col(value).isNotNull(), _ranked(F.col(value))))
    some = ranked.where("__rank IS NOT NULL").select("__rank")
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        same = some if shift == 48 else some.where(F.shiftright("__rank", shift + _DIGITS) == prefix)
        counts = same.groupBy(F.shiftright("__rank", shift).alias("digits")).count().collect()
        found = None
        for row in sorted(counts, key=lambda r: -r["digits"]):
            if left <= row["count"]:
                found = row["digits"]
                break
            left -= row["count"]
        if found is None:
            return ranked.withColumn(mark, F.col("__rank").isNotNull() & F.lit(k > 0)).drop("__rank")
        prefix = found
    level = F.lit(prefix)
    above = ranked.withColumn("__at", F.col("__rank") == level)
    order = Window.partitionBy(F.when(F.col("__at"), F.lit(-1)).otherwise(F.pmod(F.xxhash64(ties), F.lit(1 << 20)))).orderBy(F.desc(value), ties)
    return (
        above.withColumn("__place", F.row_number().over(order))
        .withColumn(mark, F.coalesce((F.col("__rank") > level) | (F.col("__at") & (F.col("__place") <= left)), F.lit(False)))
        .drop("__rank", "__at", "__place")
    )
