"""Namespaces, tier tables, validation results and rejected rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import Product, Table
from pactlake.functions.expressions import sql_text
from pactlake.operators.layout import add_partition_columns, partition_fields, stored_schema
from pactlake.operators.quality import BROKEN, mark_broken
from pactlake.operators.schema import conform
from pactlake.sources.versions import LAYER, Folder, appended, rebuilt, replaced_partitions, values

#: Partitions that are added to the catalog or dropped in one statement.
ALTERED_AT_ONCE = 500


def ensure_namespace(spark: SparkSession, product: Product) -> None:
    """The product's namespace, left as it is when present. `owner` is a reserved property."""
    properties = {"product_owner": product.team, "owner_email": product.email, "version": product.version}
    pairs = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {product.namespace} WITH DBPROPERTIES ({pairs})")


def create_table(spark: SparkSession, product: Product, table: Table, root: str) -> None:
    """An external Parquet table at root/product/tier/table, left as it is when present.

    The rows are kept in versions (see `sources.versions`); what is current under the location is picked up when the
    table is new. The catalog has the current layers as partitions, before the declared ones.
    """
    ensure_namespace(spark, product)
    if spark.catalog.tableExists(product.fqn(table.name)):
        return
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {sql_text(c)}" if (c := f.metadata.get("comment")) else "")
        for f in stored_schema(table).add(LAYER, "string")
    )
    location = product.location(root, table.name)
    properties = {
        "tier": table.tier, "product": product.name, "product_version": product.version, "versions": location,
        "product_owner": product.team, "pii_columns": ",".join(table.pii_columns), "tags": ",".join(table.tags),
    }
    fields = ", ".join(f"`{f}`" for f in [LAYER, *partition_fields(table)])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {product.fqn(table.name)} ({columns}) USING parquet PARTITIONED BY ({fields})"
        + f" LOCATION {sql_text(location)} COMMENT {sql_text(table.description or '')}"
        + f" TBLPROPERTIES ({', '.join(f'{sql_text(k)} = {sql_text(v)}' for k, v in properties.items())})"
    )
    sync_partitions(spark, product, table.name)


def sync_partitions(spark: SparkSession, product: Product, table: str) -> None:
    """Make the catalog's partitions those of the newest version. Only the folders of layers that the catalog does not
    have yet are listed."""
    fqn, depth = product.fqn(table), len(partition_fields(product.table(table)))
    folder = versions_of(spark, product, table)
    have: dict[str, set[str]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {fqn}").toLocalIterator():
        layer, _, rest = row.partition.partition("/")
        have.setdefault(layer.removeprefix(f"{LAYER}="), set()).add(rest)
    add, drop, layers = [], [], {x.name: x for x in folder.current().layers}
    for name, layer in layers.items():
        if name not in have:
            add += [f"{LAYER}={name}/{path}".rstrip("/") for path in folder.partitions(layer, depth)]
    for name, paths in have.items():
        gone = paths if name not in layers else paths & set(layers[name].without)
        drop += [f"{LAYER}={name}/{path}".rstrip("/") for path in gone]
    for verb, paths in (("ADD IF NOT EXISTS", add), ("DROP IF EXISTS", drop)):
        for begin in range(0, len(paths), ALTERED_AT_ONCE):
            specs = [_spec(path) for path in paths[begin : begin + ALTERED_AT_ONCE]]
            spark.sql(f"ALTER TABLE {fqn} {verb} {(' ' if add is paths else ', ').join(f'PARTITION ({x})' for x in specs)}")
    spark.catalog.refreshTable(fqn)


def _spec(path: str) -> str:
    return ", ".join(f"`{f}` = {'null' if v is None else sql_text(v)}" for f, v in values(path).items())


def write_table(df: DataFrame, product: Product, table: str, root: str, mode: str = "append") -> int:
    """Conform `df` and write it; returns the rows written, counted while writing.

    `mode` is append, overwrite (the partitions that `df` has rows for are replaced, a table without partitions whole)
    or rebuild (nothing of the old rows stays). The rows go to a layer of their own and the table is switched to it once they
    are whole: a write that fails or is killed leaves the table as it was, and readers never see part of one. Columns go by
    name, in the types of the stored table; a declared column that the stored table does not have is an error. The
    session's settings are left alone, so tables can be written side by side.
    """
    spark, declared = df.sparkSession, product.table(table)
    create_table(spark, product, declared, root)
    rows = add_partition_columns(conform(df, declared), declared)
    fields = partition_fields(declared)
    stored = [f for f in spark.table(product.fqn(table)).schema if f.name != LAYER]
    absent = [c for c in stored_schema(declared).names if c not in [f.name for f in stored]]
    if absent:
        raise ValueError(f"{product.fqn(table)} has no columns {absent}; alter it first")
    rows = rows.select(
        [(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored]
    )
    if fields:
        rows = rows.hint("rebalance", *fields)
    folder = versions_of(spark, product, table)
    layer, count = folder.write(rows, fields)
    if mode == "rebuild" or (mode == "overwrite" and not fields):
        change = rebuilt(layer)
    elif mode == "overwrite":
        change = replaced_partitions(layer, folder.partitions(layer, len(fields)))
    else:
        change = appended(layer)
    folder.commit(mode, change)
    sync_partitions(spark, product, table)
    return count


def versions_of(spark: SparkSession, product: Product, table: str) -> Folder:
    """The versioned folder of a table."""
    return Folder(spark, spark.sql(f"SHOW TBLPROPERTIES {product.fqn(table)} ('versions')").first().value)


def restore_table(spark: SparkSession, product: Product, table: str, number: int) -> int:
    """Make the rows of an earlier version, which must be kept still, the newest one; returns its number."""
    folder = versions_of(spark, product, table)
    earlier = folder.version(number)
    made = folder.commit("restore", lambda now: replace(earlier, marks=now.marks))
    sync_partitions(spark, product, table)
    return made.number


def expire_versions(spark: SparkSession, product: Product, table: str, keep: int = 1, grace_hours: float = 24) -> int:
    """Delete the rows that none of the newest `keep` versions has, and what writes have left behind that died more than
    `grace_hours` ago; returns the layers deleted. Readers of older versions must be through."""
    return versions_of(spark, product, table).expire(keep, round(grace_hours * 3_600_000))


def drop_product(spark: SparkSession, product: Product) -> int:
    """Drop the product's tables, then its namespace if nothing else is in it; missing ones are ignored. Files stay."""
    dropped = 0
    for table in product.tables:
        if spark.catalog.databaseExists(product.namespace) and spark.catalog.tableExists(product.fqn(table.name)):
            spark.sql(f"DROP TABLE IF EXISTS {product.fqn(table.name)}")
            dropped += 1
    if spark.catalog.databaseExists(product.namespace) and spark.sql(f"SHOW TABLES IN {product.namespace}").isEmpty():
        spark.sql(f"DROP NAMESPACE IF EXISTS {product.namespace}")
    return dropped


def write_results(results: DataFrame, run_date: str, location: str) -> None:
    """Append the results of a validation run under its date."""
    stamped = results.withColumn("run_date", F.lit(run_date).cast("date"))
    stamped.write.mode("append").option("compression", "snappy").partitionBy("run_date").parquet(location)


def write_quarantine(df: DataFrame, table: Table, location: str) -> None:
    """Mark the rows once and store them under ``rejected=false`` and ``rejected=true``.

    Nothing of an earlier run stays, whatever the session's overwrite mode.
    """
    store_marked(mark_broken(df, table), location)


def store_marked(marked: DataFrame, location: str) -> None:
    """Store the rows of `mark_broken` by whether they are rejected."""
    sided = marked.withColumn("rejected", F.size(BROKEN) > 0)
    writer = sided.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "static")
    writer.partitionBy("rejected").parquet(location)


def read_quarantine(spark: SparkSession, location: str, rejected: bool) -> DataFrame:
    """One side of a stored quarantine; only its directory is read. A side without rows keeps its columns."""
    return spark.read.parquet(location).where(F.col("rejected") == rejected).drop("rejected")
