"""Validation of a table that reads only what was written since the last run.

The rows of a versioned table lie in layers that never change, so what a suite has to know of a layer is worked out once,
by partition, and kept beside the table. A run scans the layers that nobody has looked at yet, adds the states of those that
the current version has, leaves out the partitions that were replaced or have expired, and judges the sum. For ``unique``
the values of a column are kept with their counts, so the run reads those instead of the rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Product, Table
from pactlake.operators.layout import partition_fields
from pactlake.operators.quality import checks
from pactlake.operators.rule_states import STATE, judged, rule_states, unique_columns, value_counts
from pactlake.sources.versions import LAYER, Folder, Layer, Version, alive
from pactlake.sources.writers import versions_of

#: The layer that a state is of.
OF = "of_layer"


def _rules(table: Table) -> str:
    """Tells a suite from others: states of other rules are of no use."""
    said = [[r.kind, c, r.params] for r, c in checks(table)]
    return hashlib.sha256(json.dumps(said, default=str, sort_keys=True).encode()).hexdigest()[:16]


def _states(folder: Folder, table: Table) -> tuple[Folder, dict[str, Folder]]:
    base = f"{folder.location}/_suites/{_rules(table)}"
    spark = folder.spark
    return Folder(spark, f"{base}/states"), {c: Folder(spark, f"{base}/values-{i}") for i, c in enumerate(unique_columns(table))}


def _known(states: Folder) -> set[str]:
    return {name for layer in states.current().layers for name in layer.facts["of"]}


def unseen_layers(spark: SparkSession, product: Product, table: str) -> list[Layer]:
    """The layers of the newest version that the next run has to read."""
    folder = versions_of(spark, product, table)
    known = _known(_states(folder, product.table(table))[0])
    return [x for x in folder.current().layers if x.name not in known]


def run_suite_incremental(spark: SparkSession, product: Product, table: str, as_of: str | None = None) -> DataFrame:
    """The results of the suite over the newest version of a table, as `run_suite` gives them for its rows."""
    declared = product.table(table)
    folder, fields = versions_of(spark, product, table), partition_fields(declared)
    version = folder.current()
    schema = T.StructType([f for f in spark.table(product.fqn(table)).schema if f.name != LAYER])
    kinds = [f for f in schema if f.name in fields]
    states, values = _states(folder, declared)
    new = [x for x in version.layers if x.name not in _known(states)]
    if new:
        # Whole layers, whatever of them was replaced: an earlier version may come back.
        rows = folder.read_layers(schema, fields, [replace(x, without=()) for x in new]).withColumnRenamed(LAYER, OF)
        for column, kept in values.items():
            _add(kept, value_counts(rows, column, OF, *fields), new)
        _add(states, rule_states(rows, declared, OF, *fields), new)
    sums = {c: _read(kept, f"value {_type(schema, c)}, n long", kinds, version) for c, kept in values.items()}
    return judged(_read(states, STATE, kinds, version), sums, declared, product.name, as_of)


def _type(schema: T.StructType, column: str) -> str:
    return schema[column].dataType.simpleString()


def _add(kept: Folder, rows: DataFrame, layers: list[Layer]) -> None:
    """Keep what was worked out of some layers. Runs that do the same at the same time add it once."""
    layer, _ = kept.write(rows)
    names = [x.name for x in layers]

    def change(now: Version) -> Version | None:
        if {n for x in now.layers for n in x.facts["of"]} & set(names):
            return None
        return replace(now, layers=(*now.layers, replace(layer, facts={"of": names})))

    kept.commit("states", change)


def _read(kept: Folder, columns: str, kinds: list[T.StructField], version: Version) -> DataFrame:
    """What is kept of the partitions that a version has."""
    schema = T.StructType.fromDDL(f"{OF} string, {columns}")
    for f in kinds:
        schema = schema.add(f.name, f.dataType)
    rows = kept.read(schema).where(F.col(OF).isin([x.name for x in version.layers]))
    return alive(rows, OF, version.layers, {f.name: f.dataType for f in kinds})
