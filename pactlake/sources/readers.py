"""Reading raw sources, in batch and as streams, and product tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Product, Table
from pactlake.operators.layout import partition_fields
from pactlake.operators.schema import conform, contract_schema
from pactlake.sources.versions import LAYER

TEXT_FORMATS = ("csv", "json")


def source_schema(table: Table) -> T.StructType:
    """How a text source is read: scalars as strings, to be cast by `conform`, so that bad values are seen."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return T.StructType(
        [
            T.StructField(f.name, f.dataType if isinstance(f.dataType, nested) else T.StringType())
            for f in contract_schema(table)
        ]
    )


def read_source(
    spark: SparkSession, path: str, table: Table, format: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """A raw source as it is. Text sources are never inferred: CSV columns come by the header's names, JSON fields by
    `schema`, or by the declared names where none is given."""
    reader = spark.read.format(format).options(**options)
    if format == "csv":
        reader = reader.option("header", options.get("header", True))
    elif format == "json":
        reader = reader.schema(schema or source_schema(table))
    return reader.load(path)


def ingest(
    spark: SparkSession,
    path: str,
    table: Table,
    format: str = "parquet",
    where: str | None = None,
    rename: dict[str, str] | None = None,
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """A named raw source, filtered, in the columns and types of a bronze table.

    `where` is over the source's own columns, so a columnar source applies it in the scan.
    `rename` maps declared names to source expressions. `schema` names the fields of a JSON source whose own names
    those are.
    """
    raw = read_source(spark, path, table, format, schema, **options)
    if where:
        raw = raw.where(where)
    if rename:
        raw = raw.withColumns({name: F.expr(expression) for name, expression in rename.items()})
    return conform(raw, table)


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", offset: str | None = None, **options
) -> DataFrame:
    """B2: a growing folder as a stream. `offset` adds where each row comes from: under that name its position in its file,
    and under the name and ``_file`` the file. Only Parquet knows positions; other formats are refused with a ValueError
    rather than given rows that cannot be found again."""
    if offset and format != "parquet":
        raise ValueError(f"rows of {format} files have no position")
    stream = spark.readStream.format(format).schema(schema).options(**options).load(path)
    if not offset:
        return stream
    return stream.withColumns({offset: F.col("_metadata.row_index"), f"{offset}_file": F.col("_metadata.file_path")})


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType, offset: str) -> DataFrame:
    """B2: JSON records of a topic with their offset. Needs the Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return records.select(F.from_json(F.col("value").cast("string"), schema).alias("r"), "offset").select(
        "r.*", F.col("offset").alias(offset)
    )


def read_table(spark: SparkSession, product: Product, table: str, version: int | None = None) -> DataFrame:
    """A product table by name: its declared columns, and the derived partition columns after them. What is read
    is the version that is newest now, or the one asked for, whatever is written meanwhile."""
    from pactlake.sources.writers import versions_of

    stored = spark.table(product.fqn(table)).schema
    schema = T.StructType([f for f in stored if f.name != LAYER])
    folder = versions_of(spark, product, table)
    return folder.read(schema, partition_fields(product.table(table)), None if version is None else folder.version(version))
