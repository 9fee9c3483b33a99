"""Deploy, validate and tear down a product: the table, rule and log operators in the order a user needs them.

The overviews over deployed products are `deployments.listing` and `deployments.resource_matrix`.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from pactlake.contract import Product, Table
from pactlake.functions.expressions import timestamp_literal
from pactlake.operators import deployments
from pactlake.operators.layout import TIME_TRANSFORMS, partition_fields
from pactlake.operators.quality import run_suite, verdict
from pactlake.operators.schema import contract_inventory, inventory, schema_drift
from pactlake.operators.sla import availability, freshness_lag, row_count_bounds
from pactlake.sources.readers import read_table
from pactlake.sources.writers import create_table, drop_product, ensure_namespace


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(deployments.LOG_SCHEMA).parquet(log)


def current(spark: SparkSession, product: Product, log: str) -> DataFrame:
    try:
        return deployments.get(read_log(spark, log), product.name)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # nothing was ever deployed
            raise
        return spark.createDataFrame([], deployments.LOG_SCHEMA)


def deploy(spark: SparkSession, product: Product, root: str, log: str, at: str, force: bool = False) -> str:
    """Make what is missing and record it; 'skipped' when this version is deployed already.

    Tables that exist stay as they are, so a contract that no longer fits one is recorded as an error:
    the deployment is then 'partial'. One table failing does not keep the others from being made.
    """
    last = current(spark, product, log).first()
    if last and last.version == product.version and not force:
        return "skipped"
    ensure_namespace(spark, product)
    made: list[Table] = []
    errors: list[str] = []
    for table in product.in_tier_order():
        try:
            create_table(spark, product, table, root)
            made.append(table)
        except Exception as e:  # recorded, as the caller sees by the status
            errors.append(f"{table.name}: {e}")
    errors += [
        f"{r.table}.{r.column}: {r.change} (declared {r.expected}, found {r.actual})"
        for r in live_drift(spark, product, made).collect()
    ]
    tables = [
        {
            "name": t.name, "tier": t.tier,
            # A table is registered when it was made, has a suite when it has rules and a model when it is built from others.
            "resources": ["table", *(["suite"] if t.rules else []), *(["model"] if t.inputs else [])],
        }
        for t in made
    ]
    row = spark.range(1).select(
        F.lit(product.name).alias("product"),
        F.lit(product.version).alias("version"),
        timestamp_literal(at).alias("deployed_at"),
        F.lit(last.sequence + 1 if last else 1).cast("long").alias("sequence"),
        F.lit(product.namespace).alias("namespace"),
        F.lit(json.dumps(tables)).alias("tables_json"),
        F.lit(json.dumps(errors)).alias("errors_json"),
        F.lit(False).alias("deleted"),
    )
    deployments.append(row, log)
    return "partial" if errors else "success"


def live_drift(spark: SparkSession, product: Product, tables: list[Table]) -> DataFrame:
    """A5 between the contract and the tables as they are; files do not tell nullability."""
    declared = contract_inventory(spark, product).where(F.col("table").isin([t.name for t in tables]))
    found = []
    for table in tables:
        derived = set(partition_fields(table)) - set(table.column_names)
        live = inventory(spark, product.name, table.name, read_table(spark, product, table.name).schema)
        found.append(live.where(~F.col("column").isin(list(derived))))
    none = spark.createDataFrame([], declared.schema)
    actual = reduce(DataFrame.unionByName, found, none).withColumn("nullable", F.lit(None).cast("boolean"))
    return schema_drift(declared, actual)


def validate(spark: SparkSession, product: Product, as_of: str) -> DataFrame:
    """The verdict over a deployed product: the rules of all its tables, and what its service levels promise of them.
    A promise counts as one more rule of its table."""
    if not any(t.rules for t in product.tables):
        raise ValueError(f"{product.name} declares no rules")
    tables = deployed(spark, product)
    suites = [run_suite(tables[t.name], t, product.name, as_of) for t in product.tables if t.rules]
    tiers = F.create_map(*[F.lit(x) for t in product.tables for x in (t.name, t.tier)])
    promises = service_levels(tables, product, as_of).select(
        "product", "table", tiers[F.col("table")].alias("tier"), F.col("promise").alias("rule_type"), F.lit("").alias("column"),
        F.lit(1).cast("long").alias("evaluated"), F.when(F.col("met"), 0).otherwise(1).cast("long").alias("failed"), F.col("met").alias("passed"),
    )
    return verdict(reduce(DataFrame.unionByName, [*suites, promises]))


def service_levels(tables: dict[str, DataFrame], product: Product, as_of: str, hours: int = 24) -> DataFrame:
    """what the contract promises of its tables, measured at `as_of`: one row per table and promise with
    `promise` (freshness, row_count, availability), `measured` (minutes of lag, rows, percent of the last `hours` hours) and
    `met`. What came after `as_of` makes nothing fresh. A product that is not enabled promises nothing.

    `tables` maps names to rows, of a deployed product `deployed(spark, product)`. A table's time is the column that it is
    partitioned by in time, or else its first timestamp; without one only its rows are counted.
    """
    timed = {name: (df, at) for name, df in tables.items() if (at := _time_column(product.table(name)))}
    parts = [
        row_count_bounds(tables, product.min_row_count, product.max_row_count).select(
            "table", F.lit("row_count").alias("promise"), F.col("row_count").cast("double").alias("measured"), F.col("passed").alias("met")
        )
    ]
    if timed:
        until = {name: (df.where(F.col(at) <= timestamp_literal(as_of)), at) for name, (df, at) in timed.items()}
        lag = freshness_lag(until, as_of, product.freshness_hours)
        parts.append(lag.select("table", F.lit("freshness"), F.col("lag_minutes").cast("double"), ~F.col("breached")))
    start = str(datetime.fromisoformat(as_of) - timedelta(hours=hours))
    for name, (df, at) in timed.items():
        known = df.sparkSession.createDataFrame([(name,)], "table string")
        arrivals = df.select(F.lit(name).alias("table"), at)
        share = availability(arrivals, "table", at, start, hours, product.freshness_hours, product.availability_pct, known)
        parts.append(share.select("table", F.lit("availability"), "availability_pct", "met"))
    levels = reduce(DataFrame.union, parts).select(F.lit(product.name).alias("product"), "table", "promise", "measured", "met")
    return levels if product.enabled else levels.where(F.lit(False))


def deployed(spark: SparkSession, product: Product) -> dict[str, DataFrame]:
    return {t.name: read_table(spark, product, t.name) for t in product.tables}


def _time_column(table: Table) -> str | None:
    by_time = [p.column for p in table.partitions if p.transform in TIME_TRANSFORMS]
    return next(iter(by_time + [c.name for c in table.columns if c.type in ("timestamp", "date")]), None)


def teardown(spark: SparkSession, product: Product, log: str, at: str) -> int:
    """Drop the tables, keep the files, and mark the product deleted; returns the tables dropped."""
    dropped = drop_product(spark, product)
    deployments.append(deployments.tombstones(current(spark, product, log), timestamp_literal(at)), log)
    return dropped
