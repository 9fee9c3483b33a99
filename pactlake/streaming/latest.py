"""Latest state per entity, kept as merged runs.

Each micro-batch is reduced to the newest row per entity and appended as a run; readers take the newest row over all runs. A
batch costs what its own rows cost, never a rewrite of all entities. Runs are merged while the stream goes on, so a
reader never folds more than a small multiple of the entities (see `sources.merged`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pactlake.operators.medallion import latest_state
from pactlake.sources.merged import MergedRuns
from pactlake.streaming.runs import start_merged


def latest_runs(spark: SparkSession, location: str, keys: list[str], at: str, sequence: str) -> MergedRuns:
    return MergedRuns(spark, location, keys, lambda rows: latest_state(rows, keys, at, sequence))


def stream_latest(
    stream: DataFrame, keys: list[str], at: str, sequence: str, location: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """A batch that runs again after a failure is recognised and not added twice."""
    runs = latest_runs(stream.sparkSession, location, keys, at, sequence)
    return start_merged(stream.writeStream.foreachBatch(lambda batch, number: runs.append(batch, number)), checkpoint, once, [runs])


def read_latest(spark: SparkSession, location: str, keys: list[str], at: str, sequence: str) -> DataFrame:
    return latest_runs(spark, location, keys, at, sequence).read()
