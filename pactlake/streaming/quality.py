"""The rule suite and the quarantine on a stream.

Rows are split batch by batch; the suite is judged over all batches so far, from states that each batch adds to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactlake.contract import Table
from pactlake.operators.quality import BROKEN, mark_broken, run_suite
from pactlake.operators.rule_states import (
    STATE, added_counts, added_states, judged, rule_states, unique_columns, value_counts,
)
from pactlake.sources.merged import MergedRuns
from pactlake.streaming.runs import start_merged


def suite_states(spark: SparkSession, location: str) -> MergedRuns:
    """What the checks have counted so far: one row per check."""
    return MergedRuns(spark, f"{location}/states", ["check"], added_states)


def suite_values(spark: SparkSession, location: str, table: Table) -> dict[str, MergedRuns]:
    """How often each value of the unique columns has come so far."""
    return {c: MergedRuns(spark, f"{location}/values/{i}", ["value"], added_counts) for i, c in enumerate(unique_columns(table))}


def run_suite_stream(
    stream: DataFrame, table: Table, as_of: str, location: str, checkpoint: str, product: str = "", once: bool = False
) -> StreamingQuery:
    """Rows go to ``location/rows`` split into accepted and rejected, the results of each batch on its own to
    ``location/results``, and what the suite has to know of all batches to ``location/states`` and ``location/values``, which
    `read_suite` judges.

    Rows and results are written under the batch id, so a batch that runs again after a failure replaces its own
    output; states know the batches that are in them. The split sees one batch at a time: a row whose value came in an earlier
    batch is accepted, but counts as a repeat in the suite. To keep repeats out, use `deduplicate_stream` before.
    """
    spark = stream.sparkSession
    states, values = suite_states(spark, location), suite_values(spark, location, table)

    def put(df: DataFrame, batch_id: int, name: str, *fields: str) -> None:
        writer = df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", *fields).parquet(
            f"{location}/{name}"
        )

    def check(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():  # a closing batch of a stateful query; there is nothing to store or to judge
            return
        marked = mark_broken(batch, table).withColumn("rejected", F.size(BROKEN) > 0)
        put(marked, batch_id, "rows", "rejected")
        stored = batch.sparkSession.read.schema(marked.schema).parquet(f"{location}/rows/batch_id={batch_id}")
        put(run_suite(stored, table, product, as_of), batch_id, "results")
        states.append(rule_states(stored, table), batch_id)
        for column, counts in values.items():
            counts.append(value_counts(stored, column), batch_id)

    return start_merged(stream.writeStream.foreachBatch(check), checkpoint, once, [states, *values.values()])


def read_suite(spark: SparkSession, table: Table, as_of: str, location: str, product: str = "") -> DataFrame:
    """The results of the suite over all batches so far, as `run_suite` gives them for all their rows; `as_of` is the moment of
    judgement, not of arrival."""
    states, values = suite_states(spark, location), suite_values(spark, location, table)
    if not states.folder.current().layers:
        types = {c: "string" for c in values}  # nothing has come: no value is counted
        none = {c: spark.createDataFrame([], f"value {t}, n long") for c, t in types.items()}
        return judged(spark.createDataFrame([], STATE), none, table, product, as_of)
    return judged(states.read(), {c: v.read() for c, v in values.items()}, table, product, as_of)
