"""Append-only bronze streams, with and without de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactlake.contract import Table
from pactlake.functions.skew import spread
from pactlake.operators.layout import add_partition_columns, partition_fields
from pactlake.operators.schema import conform
from pactlake.streaming.runs import start, with_event_time, without_zone


def ingest_stream(
    stream: DataFrame, table: Table, location: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append a raw stream to a bronze table in its declared columns, types and partitions.

    The file sink's commit log and the checkpoint make each source row appear exactly once, also after
    a restart from the same checkpoint. Partitioned output is rebalanced, so that a batch writes about
    one file per partition and not one per task, and an oversized partition is split over several tasks.
    """
    rows = add_partition_columns(conform(stream, table), table)
    fields = partition_fields(table)
    if fields:
        rows = rows.hint("rebalance", *fields)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", location)
    writer = writer.option("compression", "snappy")
    return start(writer.partitionBy(*fields) if fields else writer, checkpoint, once)


def deduplicate_stream(
    stream: DataFrame, keys: list[str], at: str, delay: str, salts: int = 16, forever: bool = False
) -> DataFrame:
    """The first row of each key. Rows later than the watermark's `delay` are dropped.

    State is kept only as long as a repeat may arrive (`delay`): repeats further apart both pass, which is the price of
    bounded state. With `forever` every key ever seen is kept, a key's bytes each, in the state store of the task that owns
    it: no repeat passes however late it comes, and a batch looks up its own keys only, whatever the store has grown to.
    The number of shuffle partitions that the stream starts with is how many tasks the keys are dealt out to.

    A key repeated very often is first thinned out in `salts` groups, so that the task that owns it sees at
    most one row per group; `salts=1` saves that shuffle where repeats are rare.
    """
    rows = with_event_time(stream, at, delay)
    if salts > 1:
        thinned = rows.withColumn("__salt", spread(F.struct(*keys), salts)).dropDuplicatesWithinWatermark([*keys, "__salt"])
        rows = thinned.drop("__salt")
    return without_zone(rows.dropDuplicates(keys) if forever else rows.dropDuplicatesWithinWatermark(keys), at)
