"""Operator 2: mixing sources to target weights, by weighted fair queueing.

Every source sends its documents in a shuffled order, again and again up to a limit of repeats. A document's virtual finish
time is what its source has sent by then divided by the source's target; at virtual time 1 every source has sent its
target. All documents in order of finish time, cut where the total budget is reached, are the mix.

Nothing here is ordered in one task. Running sums go in two steps, over the sums of about sqrt(n) buckets and within a
bucket of about sqrt(n) rows, so a source that owns a third of all rows is spread like the others. Only the one row at
which the mix is cut comes to the driver. Shuffled order comes from a hash of the document's id, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactlake.llm.scratch import Scratch

#: Runs of characters other than space, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(source, source_size) with the weights repeated over the sources by code point, a null source last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    return sources.withColumn("weight", F.get(listed, (F.row_number().over(order) - 1) % len(weights)))


def targets(sources: DataFrame, share: float, repeats: int) -> DataFrame:
    """Adds `target` to one row per source (source_size, weight): the given share of all sizes by weight, none above
    `repeats` times its source's size, the excess reshared by weight until none is above.

    That is one common level by weight, below which a source gets its limit: sources ordered by limit over weight, the
    level is found at the first source that it leaves below its limit. One row per source, all in one task.
    """
    limits = sources.withColumn("limit", F.col("source_size") * repeats).withColumn(
        "ratio", F.col("limit").cast("double") / F.col("weight")
    )
    everyone = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    budget = (F.sum("source_size").over(everyone) * F.lit(share)).cast("double")
    spent = F.coalesce(F.sum("limit").over(order), F.lit(0)).cast("double")
    left = (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(order), F.lit(0))).cast("double")
    leveled = limits.withColumn("level", (budget - spent) / left)
    below = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everyone)
    target = F.least(F.col("limit").cast("double"), F.coalesce(below, F.lit(math.inf)) * F.col("weight"))
    return leveled.withColumn("target", target).drop("limit", "ratio", "level")


def _narrow(documents: DataFrame, seed: str) -> DataFrame:
    shuffled = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15)
    return documents.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.conv(shuffled, 16, 10).cast("long").alias("place"), F.xxhash64("text").alias("content"),
    )


def plan_mix(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, repeats: int = 3, seed: str = "mix") -> DataFrame:
    """What the mix takes of each row of `documents`: doc_id, size, source_size, target, copies, taken (size * copies),
    begin (its first copy's virtual start), content (a hash of the text), source.

    Sizes are in words; a null text has none. A null source is a source. Rows with the same id are documents of their own.
    A document without words, and a source without any, takes part and takes nothing (0 copies). Other columns are not
    read. An empty table gives an empty result.
    """
    with Scratch(documents.sparkSession, "mix") as scratch:
        narrow = scratch.table(_narrow(documents, seed))
        sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
        sources = scratch.table(targets(cycled_weights(sources, weights), share, repeats))
        rows, budget = sources.agg(F.sum("rows"), F.sum("source_size")).first()
        buckets = max(1, math.isqrt(rows or 0))
        budget = int((budget or 0) * share)
        bucket = F.floor(F.col("place") / F.lit(2.0**60) * buckets).alias("bucket")
        rows = narrow.select("*", bucket)
        sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
        known = sources.select(F.col("source").alias("s"), "source_size", "target").join(
            sums.select(F.col("source").alias("s2"), F.col("bucket").alias("b2"), "before"),
            F.col("s").eqNullSafe(F.col("s2")),
        )
        within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        sent = (
            rows.withColumn("own", F.sum("size").over(within))
            .join(known, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2")))
            .select("doc_id", "source", "size", "place", "content", "source_size", "target", (F.col("before") + F.col("own")).alias("sent"))
        )
        sent = scratch.table(sent)
        # Null where nothing is sent, so that it is never taken.
        finish = F.expr("IF(size > 0 AND target > 0, CAST(epoch * source_size + sent AS DOUBLE) / target, NULL)")
        packets = sent.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))))
        packets = packets.select("doc_id", "size", "place", finish.alias("finish")).where("finish IS NOT NULL")
        slots = packets.withColumn("slot", F.floor(F.col("finish") * buckets))
        order = Window.orderBy("slot")
        running = slots.groupBy("slot").agg(F.sum("size").alias("in_slot")).withColumn("upto", F.sum("in_slot").over(order))
        cut = running.where(F.col("upto") > budget).orderBy("slot").first()
        copies = F.lit(repeats).cast("long")
        if cut is not None:
            order = Window.orderBy("finish", "place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
            slot = slots.where(F.col("slot") == cut["slot"]).withColumn("upto", F.sum("size").over(order) + (cut["upto"] - cut["in_slot"]))
            first = slot.where(F.col("upto") > budget).orderBy("finish", "place", F.col("doc_id").asc_nulls_first()).first()
            at = F.struct(F.lit(first["finish"]).alias("finish"), F.lit(first["place"]).alias("place"), F.lit(first["doc_id"]).cast("long").alias("doc_id"))
            copies = sum(
                F.when(
                    F.struct(F.expr(finish_at(epoch)).alias("finish"), "place", F.col("doc_id").cast("long").alias("doc_id")) < at, 1
                ).otherwise(0)
                for epoch in range(repeats)
            ).cast("long")
        return scratch.result(
            sent.withColumn("copies", F.when((F.col("size") > 0) & (F.col("target") > 0), copies).otherwise(0).cast("long")).select(
                "doc_id", "source", "size", "source_size", "target", "copies",
                (F.col("size") * F.col("copies")).alias("taken"),
                F.expr("IF(target > 0, CAST(sent - size AS DOUBLE) / target, NULL)").alias("begin"), "content",
            )
        )


def finish_at(epoch: int) -> str:
    return f"CAST({epoch} * source_size + sent AS DOUBLE) / target"


def mix(documents: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, repeats: int = 3, seed: str = "mix") -> DataFrame:
    """The mixed documents in the order of the mix, each as often as it is taken, with `epoch` and `virtual_start` added.

    A repeated row (same id and text) counts as often as it is given, and its copies come under one row's columns.
    """
    plan = plan_mix(documents, weights, share, repeats, seed).where("copies > 0")
    plan = plan.groupBy("doc_id", "content").agg(
        F.sum("copies").alias("copies"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.min("begin").alias("begin"),
    )
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    rows = documents.withColumn("__hash", F.xxhash64("text"))
    found = rows.join(plan, rows["doc_id"].eqNullSafe(F.col("__doc_id")) & (F.col("__hash") == F.col("__content")))
    once = found.dropDuplicates(["__doc_id", "__content"])
    out = once.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    start = F.col("__begin") + F.col("epoch") * F.col("__source_size") / F.col("__target")
    out = out.withColumn("virtual_start", start)
    return out.select(*documents.columns, "epoch", "virtual_start").orderBy("virtual_start", "doc_id")
