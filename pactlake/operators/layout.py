"""Partition transforms as derived columns, partitioned writes and pruned reads."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Partition, Table
from pactlake.functions.expressions import timestamp_literal
from pactlake.functions.skew import ROWS_PER_TASK, heaviest, skew_join
from pactlake.operators.schema import contract_schema
from pactlake.session import materialize

TIME_TRANSFORMS = ("year", "month", "day", "hour")
#: Buckets of a hybrid table. Each is a file and a task that reports to the driver, whatever its size.
MAX_BUCKETS = 1024


def transform(spec: Partition, value: Column, data_type: T.DataType) -> Column:
    """The partition value of `value`.

    Bucket numbers are ours (Spark's hash): in [0, n) and equal for equal keys, nothing more.
    Truncation floors integers to a multiple of the width and keeps a string's first characters.
    """
    match spec.transform:
        case "identity":
            return value
        case "year":
            return F.year(value)
        case "month":
            return F.date_format(value, "yyyy-MM")
        case "day":
            return F.to_date(value)
        case "hour":
            return F.date_format(value, "yyyy-MM-dd-HH")
        case "bucket":
            return F.pmod(F.hash(value), F.lit(spec.num_buckets))
        case "truncate":
            if isinstance(data_type, T.StringType):
                return F.substring(value, 1, spec.width)
            return value - F.pmod(value, F.lit(spec.width).cast(data_type))
    raise ValueError(f"unknown transform {spec.transform!r}")


def partition_type(spec: Partition, data_type: T.DataType) -> T.DataType:
    return {
        "year": T.IntegerType(), "month": T.StringType(), "day": T.DateType(),
        "hour": T.StringType(), "bucket": T.IntegerType(),
    }.get(spec.transform, data_type)


def add_partition_columns(df: DataFrame, table: Table) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    for spec in table.partitions:
        if spec.transform != "identity":
            df = df.withColumn(spec.field_name, transform(spec, F.col(spec.column), types[spec.column]))
        elif isinstance(types[spec.column], T.StringType):
            # A directory cannot tell an empty text from a NULL, and reading it back would change the value.
            blank = F.raise_error(F.lit(f"empty text in the partition column {spec.column}")).cast("string")
            df = df.withColumn(spec.column, F.when(F.col(spec.column) == "", blank).otherwise(F.col(spec.column)))
    return df


def partition_fields(table: Table) -> list[str]:
    return [spec.field_name for spec in table.partitions]


def stored_schema(table: Table) -> T.StructType:
    """Declared columns followed by the partition columns, as a reader of the files sees them."""
    declared = contract_schema(table)
    keys = set(partition_fields(table))
    data = [T.StructField(f.name, f.dataType, True, f.metadata) for f in declared if f.name not in keys]
    parts = [
        T.StructField(s.field_name, partition_type(s, declared[s.column].dataType), True) for s in table.partitions
    ]
    return T.StructType(data + parts)


def write_partitioned(df: DataFrame, table: Table, location: str, mode: str = "append") -> None:
    """One directory per partition value; overwrite replaces only the partitions that have rows.

    Rebalancing by the partition columns keeps the file count near the partition count, and lets AQE
    split a partition that is far larger than the others over several tasks.
    """
    out = add_partition_columns(df, table)
    fields = partition_fields(table)
    if fields:
        out = out.hint("rebalance", *fields)
    writer = out.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    if fields:
        writer = writer.partitionBy(*fields)
    writer.parquet(location)


def between(df: DataFrame, table: Table, column: str, low: Any, high: Any) -> DataFrame:
    """Rows with low <= column <= high, with the implied range on each partition column.

    Time and truncate transforms keep order, so the range carries over and whole directories are
    skipped; a bucket is implied only by equality.
    """
    data_type = contract_schema(table)[column].dataType
    bound = lambda v: timestamp_literal(v) if isinstance(data_type, T.TimestampNTZType) else F.lit(v).cast(data_type)
    lo, hi = bound(low), bound(high)
    condition = F.col(column).between(lo, hi)
    for spec in table.partitions:
        if spec.column != column or spec.transform == "identity":
            continue
        if spec.transform != "bucket":
            condition &= F.col(spec.field_name).between(
                transform(spec, lo, data_type), transform(spec, hi, data_type)
            )
        elif low == high:
            condition &= F.col(spec.field_name) == transform(spec, lo, data_type)
    return df.where(condition)


#: What a predicate may say of a column.
OPERATIONS = ("=", "<", "<=", ">", ">=", "in", "is null", "is not null")


def matching(df: DataFrame, table: Table, predicates: Iterable[tuple]) -> DataFrame:
    """Rows for which all predicates hold, each (column, operation[, value]), with what they imply for the partitions.

    Of a column that the table is partitioned by, an equal value, a list of values and NULL carry over to every
    transform; half-open ranges to those that keep order, which all but buckets do. So folders that cannot hold a matching row are
    never listed, though the predicates say nothing of partitions. The predicates themselves still hold for every row.
    """
    for column, operation, *value in predicates:
        df = df.where(_predicate(table, column, operation, *value))
    return df


def _predicate(table: Table, column: str, operation: str, value: Any = None) -> Column:
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation {operation!r}")
    data_type = contract_schema(table)[column].dataType
    literal = lambda v: timestamp_literal(v) if isinstance(data_type, T.TimestampNTZType) else F.lit(v).cast(data_type)
    compared = {
        "=": lambda c, v: c == v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    }
    holds = lambda c, turned, within: (
        c.isNull() if operation == "is null" else c.isNotNull() if operation == "is not null"
        else c.isin(*[turned(v) for v in value]) if operation == "in" else compared[within](c, turned(value))
    )
    condition = holds(F.col(column), literal, operation)
    for spec in table.partitions:
        if spec.column != column or spec.transform == "identity":
            continue
        turned = lambda v, spec=spec: transform(spec, literal(v), data_type)
        field = F.col(spec.field_name)
        if operation == "is null":
            # Every transform keeps NULL, but a bucket is the hash's.
            condition &= field == transform(spec, F.lit(None).cast(data_type), data_type) if spec.transform == "bucket" else field.isNull()
        elif operation in ("=", "in") or (spec.transform != "bucket" and operation != "is not null"):
            # The bound's own period or prefix may hold rows on both sides of it.
            condition &= holds(field, turned, {"<": "<=", ">": ">="}.get(operation, operation))
    return condition


def join_pruned(facts: DataFrame, table: Table, dimension: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """`facts` of a partitioned table joined to `dimension` on a column that partitions are made from.

    The dimension's key is given the partitions' transforms and these are joined too. They change no result, but being partition
    columns they let Spark skip the folders for which the filtered dimension has no row, at run time.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"a {how} join needs all rows")
    data_type, keys = contract_schema(table)[on].dataType, [on]
    for spec in table.partitions:
        if spec.column == on and spec.transform != "identity":
            dimension = dimension.withColumn(spec.field_name, transform(spec, F.col(on), data_type))
            keys.append(spec.field_name)
    return facts.join(dimension, keys, how)


def read_partitioned(spark, table: Table, location: str) -> DataFrame:
    return spark.read.schema(stored_schema(table)).parquet(location)


def write_bucketed(df: DataFrame, name: str, spec: Partition, location: str) -> None:
    """An external table bucketed and sorted on one key; tables with equal bucket counts join in place.

    Rebalancing on the key keeps the files per bucket few and still splits an oversized bucket over
    several tasks when writing. A bucketed join reads a bucket in one task, though: for a key with a
    value owning much of the table use `write_hybrid`.
    """
    clustered = df.hint("rebalance", spec.num_buckets, spec.column)
    writer = clustered.write.mode("errorifexists").format("parquet").option("path", location)
    writer.bucketBy(spec.num_buckets, spec.column).sortBy(spec.column).saveAsTable(name)


@dataclass(frozen=True)
class Hybrid:
    """Two catalog tables that are one: `rest`, bucketed and sorted by `key`, and `aside`, the rows of keys that are too
    frequent for a bucket, and those without a key."""

    rest: str
    aside: str
    key: str
    buckets: int


def write_hybrid(df: DataFrame, name: str, key: str, location: str, buckets: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> Hybrid:
    """A table bucketed for joins in place, whatever its keys are like.

    The number of buckets comes from the rows, a power of two of about `rows_per_task` each, so that tables of different
    size still divide evenly; `buckets` sets it, to that of a table to be joined with. There are no more than `MAX_BUCKETS`, since
    files and reports of tasks would grow with the table; buckets are sorted and so read in bounded memory, however large. Keys with
    more rows than a task should get are counted first, of which there can be but few, and are kept aside unbucketed.
    """
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("count")), "keys")
    heavy = F.broadcast(heaviest(counts.where(F.col(key).isNotNull()), rows_per_task=rows_per_task).select(key))
    if buckets is None:
        rows = counts.agg(F.sum("count")).first()[0] or 0
        buckets = min(MAX_BUCKETS, 1 << max(0, (-(-rows // rows_per_task) - 1).bit_length()))
    rest = df.where(F.col(key).isNotNull()).join(heavy, key, "left_anti").select(*df.columns)
    aside = df.join(heavy, key, "left_semi").unionByName(df.where(F.col(key).isNull())).select(*df.columns)
    write_bucketed(rest, name, Partition(key, "bucket", num_buckets=buckets), f"{location}/rest")
    aside.write.mode("errorifexists").format("parquet").option("path", f"{location}/aside").saveAsTable(f"{name}_aside")
    return Hybrid(name, f"{name}_aside", key, buckets)


def join_hybrid(spark: SparkSession, left: Hybrid, right: Hybrid, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The inner join of two hybrid tables on their key, which must have one name; other columns must differ.

    Bucket meets bucket in place, without a shuffle. A key that is aside in either table meets the other's rows of that
    key in a salted join, which reads of the other's buckets no more than those rows.
    """
    if left.key != right.key:
        raise ValueError(f"keys {left.key} and {right.key} differ")
    key = left.key
    l_rest, l_aside, r_rest, r_aside = (spark.table(t).where(F.col(key).isNotNull()) for t in (left.rest, left.aside, right.rest, right.aside))
    columns = [key, *[c for c in l_rest.columns if c != key], *[c for c in r_rest.columns if c != key]]
    in_place = l_rest.join(r_rest, key)
    # At most rows / rows_per_task keys are aside.
    only = lambda rows, aside: rows.join(F.broadcast(aside.select(key).distinct()), key, "left_semi")
    left_hot = skew_join(l_aside, only(r_rest, l_aside).unionByName(r_aside), [key], "inner", rows_per_task)
    right_hot = skew_join(r_aside, only(l_rest, r_aside), [key], "inner", rows_per_task)
    return in_place.select(*columns).unionByName(left_hot.select(*columns)).unionByName(right_hot.select(*columns))
