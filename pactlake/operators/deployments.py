"""H1-H7: the deployment log.

The log only grows: deploying again appends a row, deleting appends a tombstone, and the current state
is the latest row per product. Tables and errors are JSON text, as they arrive from deployers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlake.functions.skew import latest_per_key, skew_join

LOG_SCHEMA = (
    "product string, version string, deployed_at timestamp_ntz, sequence long, namespace string,"
    " tables_json string, errors_json string, deleted boolean"
)
#: What is asked of a deployed table: its name and tier, and which kinds of resource were made for it.
RESOURCES = ("table", "suite", "model")
TABLES_JSON = "array<struct<name: string, tier: string, resources: array<string>>>"


def append(log: DataFrame, location: str) -> None:
    """H1: record deployments."""
    log.write.mode("append").option("compression", "snappy").parquet(location)


def tombstones(latest_rows: DataFrame, at: Column) -> DataFrame:
    """H4: the rows that delete the given products, to be appended. `at` must be later than they are."""
    return latest_rows.withColumns({"deployed_at": at, "sequence": F.col("sequence") + 1, "deleted": F.lit(True)})


def latest(log: DataFrame) -> DataFrame:
    """H1, H4: the current deployment of each product that has not been deleted; a row that does not say so has not."""
    return latest_per_key(log, ["product"], ["deployed_at", "sequence"]).where(~F.coalesce("deleted", F.lit(False)))


def get(log: DataFrame, product: str) -> DataFrame:
    """H2: one product, empty if unknown; the name reaches the scan before the latest row is picked."""
    return latest(log.where(F.col("product") == product))


def status(errors: Column) -> Column:
    """H7: partial when anything went wrong."""
    return F.when(F.size(errors) > 0, "partial").otherwise("success")


def listing(latest_rows: DataFrame) -> DataFrame:
    """H3, H7: the overview of deployed products."""
    errors = F.from_json("errors_json", "array<string>")
    return latest_rows.select(
        "product",
        "version",
        "deployed_at",
        F.size(F.from_json("tables_json", TABLES_JSON)).alias("tables"),
        status(errors).alias("status"),
        F.array_join(errors, "; ").alias("errors"),
    )


def resource_matrix(latest_rows: DataFrame) -> DataFrame:
    """H5: per deployed table, which resources exist for it."""
    tables = latest_rows.select("product", F.inline(F.from_json("tables_json", TABLES_JSON)))
    there = lambda kind: F.coalesce(F.array_contains("resources", kind), F.lit(False))
    return tables.select(
        "product", F.col("name").alias("table"), "tier",
        there("table").alias("registered"), there("suite").alias("suite"), there("model").alias("model"),
    )


def redeploy_gate(requests: DataFrame, latest_rows: DataFrame) -> DataFrame:
    """H6: requests (product, version, force) with the deployed version and whether to go ahead.

    A product asked for again and again is a hot key of the join.
    """
    current = latest_rows.select("product", F.col("version").alias("deployed_version"))
    same = F.coalesce(F.col("version") == F.col("deployed_version"), F.lit(False))
    return skew_join(requests, current, ["product"], "left").withColumn("deploy", ~same | F.coalesce("force", F.lit(False)))
