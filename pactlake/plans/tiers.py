"""Build a product tier by tier and stop where the inputs failed."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from pactlake.contract import Product, Table
from pactlake.operators.quality import BROKEN, gate, run_suite
from pactlake.session import materialize
from pactlake.sources.readers import read_table
from pactlake.sources.writers import ensure_namespace, store_marked, write_results, write_table

Build = Callable[[dict[str, DataFrame]], DataFrame]
OUTCOME_SCHEMA = (
    "product string, tier string, table string, status string, rows long, rejected long, failed_rules long, error string"
)


@dataclass
class Outcome:
    tier: str
    table: str
    status: str
    rows: int = 0
    rejected: int = 0
    failed_rules: int = 0
    error: str | None = None


def run_product(
    spark: SparkSession, product: Product, builds: dict[str, Build], root: str, as_of: str, side_by_side: int = 4
) -> DataFrame:
    """Write every table of `product` from bronze to gold, inputs first; one outcome row per table. Tables of a tier that do
    not read each other are written at the same time, up to `side_by_side`, so that a small one need not wait for the
    stragglers of a large one.

    ``builds[table]`` gets the tables named in its inputs, as read back from storage: each table is
    computed once however many others use it. Every table is rebuilt whole: no row of an earlier run stays.

    A build that returns rows marked by `mark_broken` has its rejected rows stored under
    ``root/product/_rejected/table`` and counted; the marking is done once. A table whose checks fail is kept for inspection, a
    build that raises is recorded with its error; either blocks the tables that read it, the others go on. Results go to
    ``root/product/_results``.
    """
    done: dict[str, Outcome] = {}
    tables: dict[str, DataFrame] = {}
    ensure_namespace(spark, product)

    def run(table: Table) -> DataFrame | None:
        outcome = done[table.name]
        if any(done[i].status != "passed" for i in table.inputs if i in done):
            outcome.status = "blocked"
            return None
        try:
            return _build(spark, product, table, builds, tables, root, as_of, outcome)
        except Exception as e:  # recorded, as the caller sees by the status
            outcome.status, outcome.error = "error", f"{type(e).__name__}: {e}"[:2000]

    waiting = product.in_tier_order()
    with ThreadPoolExecutor(side_by_side) as pool:
        while waiting:
            names = {t.name for t in waiting}
            ready = [t for t in waiting if t.tier == waiting[0].tier and not names & set(t.inputs)]
            done |= {t.name: Outcome(t.tier, t.name, "passed") for t in ready}
            # One append for all: writers of plain folders must not meet.
            if results := [r for r in pool.map(run, ready) if r is not None]:
                write_results(reduce(DataFrame.unionByName, results), as_of[:10], f"{root}/{product.name}/_results")
            waiting = [t for t in waiting if t not in ready]
    rows = [
        (product.name, o.tier, o.table, o.status, o.rows, o.rejected, o.failed_rules, o.error) for o in done.values()
    ]
    return spark.createDataFrame(rows, OUTCOME_SCHEMA)


def _build(
    spark: SparkSession, product: Product, table: Table, builds: dict[str, Build], tables: dict[str, DataFrame],
    root: str, as_of: str, outcome: Outcome,
) -> DataFrame | None:
    """Write one table and judge it; returns the results of its rules, if it has any."""
    rows = builds[table.name]({i: tables[i] for i in table.inputs if i in tables})
    if BROKEN in rows.columns:
        location = f"{root}/{product.name}/_rejected/{table.name}"
        store_marked(rows, location)
        sides = spark.read.schema(rows.schema.add("rejected", "boolean")).parquet(location)
        outcome.rejected = sides.where("rejected").count()
        rows = sides.where("not rejected").drop("rejected", BROKEN)
    outcome.rows = write_table(rows, product, table.name, root, mode="rebuild")
    tables[table.name] = read_table(spark, product, table.name).select(table.column_names)
    if not table.rules:
        return None
    results = materialize(run_suite(tables[table.name], table, product.name, as_of), "results")
    if not gate(results):
        outcome.status = "failed"
        outcome.failed_rules = results.where("not passed").count()
    return results
