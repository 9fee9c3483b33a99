"""Starting streams and the two time types.

Watermarks need ``TIMESTAMP``; contracts declare timestamps without zone. Streams convert on the way in
and back on the way out, which is lossless in a session whose zone is UTC.
"""

from __future__ import annotations

from threading import Thread

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pactlake.sources.merged import MergedRuns, Merger


def with_event_time(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """The stream with `at` as event time, tolerating rows up to `delay` late."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def without_zone(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def start(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    """Start `writer`; `once` works off what is there and stops, otherwise it keeps running."""
    writer = writer.option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
    return query


def start_merged(writer: DataStreamWriter, checkpoint: str, once: bool, runs: list[MergedRuns], seconds: float = 30.0) -> StreamingQuery:
    """`start`, with the runs merged in the background for as long as the query runs."""
    if once:
        query = start(writer, checkpoint, once)
        for each in runs:
            each.merge()
        return query
    query, merger = start(writer, checkpoint, once), Merger(runs, seconds)

    def wait() -> None:
        try:
            query.awaitTermination()
        finally:
            merger.stop()

    Thread(target=wait, name="merger-end", daemon=True).start()
    return query
