"""Arrivals per time window and late rows.

`arrivals` in append mode gives a window out once it is closed. `upsert_arrivals` keeps a table of all windows, open ones
included, from the same aggregation in update mode: a batch adds a run of the windows that it changed, and the newest
row of a window counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactlake.functions.skew import latest_per_key
from pactlake.sources.merged import MergedRuns
from pactlake.streaming.runs import start, start_merged, with_event_time, without_zone

BATCH = "batch_id"


def arrivals(
    stream: DataFrame, at: str, delay: str, size: str, freshness_hours: int, slide: str | None = None
) -> DataFrame:
    """I4: rows per tumbling (or sliding) window, and whether the window ended without fresh data.

    In append mode a window comes out once the watermark has passed its end; open windows are withheld.
    Partial counts per task go to the shuffle, so a window holding most rows is not a hot key.
    """
    window = F.window(at, size, slide) if slide else F.window(at, size)
    counted = with_event_time(stream, at, delay).groupBy(window).agg(
        F.count(F.lit(1)).alias("arrivals"), F.max(at).alias("last_arrival")
    )
    quiet = F.timestamp_diff("SECOND", F.col("last_arrival"), F.col("window.end"))
    out = counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "arrivals",
        "last_arrival",
        (quiet > freshness_hours * 3600).alias("breached"),
    )
    return without_zone(out, "window_start", "window_end", "last_arrival")


def window_runs(spark: SparkSession, location: str) -> MergedRuns:
    key = ["window_start", "window_end"]
    return MergedRuns(spark, location, key, lambda rows: latest_per_key(rows, key, [BATCH]))


def upsert_arrivals(windows: DataFrame, location: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """I4: keep the result of `arrivals` as a table at `location` that has every window from its first row on."""
    runs = window_runs(windows.sparkSession, location)
    write = lambda batch, number: runs.append(batch.withColumn(BATCH, F.lit(number).cast("long")), number)
    return start_merged(windows.writeStream.outputMode("update").foreachBatch(write), checkpoint, once, [runs])


def read_arrivals(spark: SparkSession, location: str, delay_hours: float) -> DataFrame:
    """All windows so far, and whether they are closed: the newest row of all is more than the delay past their end, so that
    no row can be added any more."""
    rows = window_runs(spark, location).read().drop(BATCH)
    newest = rows.agg(F.max("last_arrival")).first()[0]
    since = F.timestamp_diff("SECOND", F.col("window_end"), F.lit(newest).cast("timestamp_ntz"))
    return rows.withColumn("closed", since >= F.lit(delay_hours * 3600))


def count_late(
    stream: DataFrame, at: str, arrived: str, freshness_hours: int, location: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Rows and late rows per micro-batch and event day; late means arriving after the freshness bound."""
    late = F.timestamp_diff("SECOND", F.col(at), F.col(arrived)) > freshness_hours * 3600

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.to_date(at).alias("day")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late_rows")
        )
        writer = counts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(location)

    return start(stream.writeStream.foreachBatch(write), checkpoint, once)
