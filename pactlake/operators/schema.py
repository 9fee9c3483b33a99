"""A1-A5: declared schema, conforming rows to it, required columns and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Column, Product, Table

SIMPLE_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}
INVENTORY_SCHEMA = "product string, table string, column string, type string, nullable boolean"


def column_type(column: Column) -> T.DataType:
    """Spark type of a declared column; timestamps are without zone, decimals exactly as declared."""
    if column.type == "decimal":
        return T.DecimalType(column.precision, column.scale)
    if column.type == "array":
        return T.ArrayType(_element_type(column.element))
    if column.type == "map":
        return T.MapType(T.StringType(), _element_type(column.element))
    if column.type == "struct":
        return T.StructType([_field(f) for f in column.fields])
    return SIMPLE_TYPES[column.type]


def _element_type(element: str | Column) -> T.DataType:
    return column_type(element) if isinstance(element, Column) else SIMPLE_TYPES[element]


def _field(column: Column) -> T.StructField:
    metadata = {"comment": column.description or "", "pii": column.pii, "tags": list(column.tags)}
    return T.StructField(column.name, column_type(column), column.nullable, metadata)


def contract_schema(table: Table) -> T.StructType:
    """A1: names, types, nullability, comment and personal-data flag."""
    return T.StructType([_field(c) for c in table.columns])


def source_columns(df: DataFrame, names: list[str]) -> dict[str, str]:
    """Declared names and the source columns they mean, by Spark's own rule for letter case; absent ones are left out."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    same = (lambda a, b: a == b) if exact else (lambda a, b: a.lower() == b.lower())
    found = {name: [c for c in df.columns if same(c, name)] for name in names}
    if unclear := {n: c for n, c in found.items() if len(c) > 1}:
        raise ValueError(f"columns that differ by letter case only: {unclear}")
    return {name: columns[0] for name, columns in found.items() if columns}


def conform(df: DataFrame, table: Table) -> DataFrame:
    """A2: declared columns in declared order and type; an absent nullable column becomes NULL.

    A value that cannot be cast becomes NULL instead of failing the job; `cast_failures` counts those.
    """
    found = source_columns(df, table.column_names)
    missing = [c for c in table.required_columns if c not in found]
    if missing:
        raise ValueError(f"{table.name}: required columns {missing} are absent from the source")
    return df.select(
        [
            (F.col(f"`{found[f.name]}`").try_cast(f.dataType) if f.name in found else F.lit(None).cast(f.dataType)).alias(
                f.name, metadata=f.metadata
            )
            for f in contract_schema(table)
        ]
    )


def cast_failures(df: DataFrame, table: Table) -> DataFrame:
    """A3: per declared column, values that were set and turn NULL when cast. One scan, one row per column."""
    found = source_columns(df, table.column_names)
    fields = [f for f in contract_schema(table) if f.name in found]
    counted = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f"n{i}")
            for i, f in enumerate(fields)
        ]
    )
    rows = [F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("failed")) for i, f in enumerate(fields)]
    return counted.select(F.inline(F.array(*rows)))


def enforce_required(df: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """A4: rows with every required column set, and the rows to reject."""
    broken = F.lit(False)
    for name in table.required_columns:
        broken = broken | F.col(name).isNull()
    return df.where(~broken), df.where(broken)


def inventory(spark: SparkSession, product: str, table: str, schema: T.StructType) -> DataFrame:
    """Column inventory of one table, the form `schema_drift` compares."""
    rows = [(product, table, f.name, f.dataType.simpleString(), f.nullable) for f in schema]
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def contract_inventory(spark: SparkSession, product: Product) -> DataFrame:
    rows = [
        (product.name, t.name, f.name, f.dataType.simpleString(), f.nullable)
        for t in product.tables
        for f in contract_schema(t)
    ]
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def contract_diff(spark: SparkSession, old: Product, new: Product) -> DataFrame:
    """A5 between two versions of a contract, tables that came or went column by column; and, as `moved`, the columns that
    stand elsewhere among those that both versions have."""
    drift = schema_drift(contract_inventory(spark, old), contract_inventory(spark, new).withColumn("product", F.lit(old.name)))
    moved = []
    for table in new.tables:
        before = next((t.column_names for t in old.tables if t.name == table.name), [])
        kept = [c for c in before if c in table.column_names]
        now = [c for c in table.column_names if c in kept]
        moved += [
            (old.name, table.name, c, "moved", str(kept.index(c)), str(now.index(c))) for c in now if kept.index(c) != now.index(c)
        ]
    return drift.union(spark.createDataFrame(moved, drift.schema))


def schema_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """A5: added, removed, retyped and re-nullabled columns between two inventories.

    Columns whose live nullability is unknown (files always read as nullable) carry a NULL there.
    A column that changed type and nullability gives two rows.
    """
    keys = ["product", "table", "column"]
    side = lambda df, s: df.select(*keys, F.struct("type", "nullable").alias(s))
    both = side(expected, "e").join(side(actual, "a"), keys, "full_outer")
    word = lambda c: F.when(c, "nullable").otherwise("required")
    change = lambda name, old, new: F.struct(F.lit(name).alias("change"), old.alias("expected"), new.alias("actual"))
    e, a = F.col("e"), F.col("a")
    changes = F.array_compact(
        F.array(
            F.when(e.isNull(), change("added", F.lit(None).cast("string"), a["type"])),
            F.when(a.isNull(), change("removed", e["type"], F.lit(None).cast("string"))),
            F.when(e["type"] != a["type"], change("type", e["type"], a["type"])),
            F.when(
                e["nullable"] != a["nullable"], change("nullability", word(e["nullable"]), word(a["nullable"]))
            ),
        )
    )
    return both.select(*keys, F.inline(changes))


PATHS_SCHEMA = "product string, table string, path string, parent string, name string, type string, nullable boolean"


def path_inventory(spark: SparkSession, product: str, table: str, schema: T.StructType) -> DataFrame:
    """Every field of a schema at any depth by its path, the form `path_drift` compares. Elements of arrays are named
    ``element``, keys and values of maps ``key`` and ``value``; a nested type is only called struct, array or map."""
    rows: list[tuple] = []

    def add(parent: str, name: str, kind: T.DataType, nullable: bool) -> None:
        path = f"{parent}.{name}" if parent else name
        inside = {"struct": T.StructType, "array": T.ArrayType, "map": T.MapType}
        said = next((n for n, k in inside.items() if isinstance(kind, k)), kind.simpleString())
        rows.append((product, table, path, parent, name, said, nullable))
        if isinstance(kind, T.StructType):
            for f in kind:
                add(path, f.name, f.dataType, f.nullable)
        elif isinstance(kind, T.ArrayType):
            add(path, "element", kind.elementType, kind.containsNull)
        elif isinstance(kind, T.MapType):
            add(path, "key", kind.keyType, False)
            add(path, "value", kind.valueType, kind.valueContainsNull)

    for f in schema:
        add("", f.name, f.dataType, f.nullable)
    return spark.createDataFrame(rows, PATHS_SCHEMA)


def path_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """A5 inside nested columns: (product, table, path, change, expected, actual) between two inventories of paths.

    A change is told once, where it is: fields that came, went or lost their meaning with the struct, array or map
    that they are in are not told again. A field that went from one place and came, of the same name and type, to one other of
    its table has moved, `expected` and `actual` being its paths. Unknown nullability (NULL) is no change.
    """
    keys = ["product", "table", "path"]
    facts = ["parent", "name", "type", "nullable"]
    side = lambda df, s: df.select(*keys, F.struct(*facts).alias(s))
    both = side(expected, "e").join(side(actual, "a"), keys, "full_outer")
    e, a = F.col("e"), F.col("a")
    word = lambda c: F.when(c, "nullable").otherwise("required")
    none = F.lit(None).cast("string")
    change = lambda name, old, new: F.struct(F.lit(name).alias("change"), old.alias("expected"), new.alias("actual"))
    changes = F.array_compact(
        F.array(
            F.when(e.isNull(), change("added", none, a["type"])),
            F.when(a.isNull(), change("removed", e["type"], none)),
            F.when(e["type"] != a["type"], change("type", e["type"], a["type"])),
            F.when(e["nullable"] != a["nullable"], change("nullability", word(e["nullable"]), word(a["nullable"]))),
        )
    )
    named = [F.coalesce(e[f], a[f]).alias(f) for f in ("parent", "name")]
    rows = both.where(F.size(changes) > 0).select(*keys, *named, F.inline(changes))
    outer = rows.where(F.col("change") != "nullability").select("product", "table", F.col("path").alias("parent")).distinct()
    told = rows.join(outer, ["product", "table", "parent"], "left_anti")
    # A name and type that went once and came once.
    like = ["product", "table", "name", "kind"]
    moving = told.where(F.col("change").isin("added", "removed")).withColumn("kind", F.coalesce("expected", "actual"))
    gone, came = F.col("change") == "removed", F.col("change") == "added"
    moved = moving.groupBy(*like).agg(
        F.count_if(gone).alias("gone"), F.count_if(came).alias("came"),
        F.max(F.when(gone, F.col("path"))).alias("expected"), F.max(F.when(came, F.col("path"))).alias("actual"),
    ).where("gone = 1 AND came = 1")
    ends = moved.select("product", "table", F.explode(F.array("expected", "actual")).alias("path"))
    out = [*keys, "change", "expected", "actual"]
    still = told.where(~(gone | came)).select(*out).union(told.where(gone | came).join(ends, keys, "left_anti").select(*out))
    return still.union(moved.select("product", "table", F.col("expected").alias("path"), F.lit("moved").alias("change"), "expected", "actual"))
