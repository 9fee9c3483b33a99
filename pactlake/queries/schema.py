from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import Column, Table
from pactlake.operators.schema import cast_failures, conform, contract_schema, enforce_required, path_drift, schema_drift
from pactlake.queries.mesh import MESH_SQL, contract_corpus
from pactlake.queries.registry import contract, load, query


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk
FROM orders
""")
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns, order and types; o_clerk is declared but not delivered."""
    table = contract("retail_orders").table("raw_orders")
    out = conform(load(spark, sf_dir, "orders"), table)
    return out.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("""
SELECT 'o_orderkey' AS "column", 'bigint' AS type, true AS required, count(o_orderkey) AS filled FROM orders
UNION ALL SELECT 'o_custkey', 'bigint', true, count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', false, count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'decimal(18,2)', false, count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', true, count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', false, count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_clerk', 'string', false, CAST(0 AS BIGINT)
""")
def contract_schema_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the schema a contract declares, with the values the source has for each column."""
    table = contract("retail_orders").table("raw_orders")
    fields = contract_schema(table).fields
    counts = conform(load(spark, sf_dir, "orders"), table).agg(*[F.count(f.name).alias(f.name) for f in fields])
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(not f.nullable).alias("required"),
            F.col(f.name).alias("filled"),
        )
        for f in fields
    ]
    return counts.select(F.inline(F.array(*rows)))


@query("""
WITH s AS (
  SELECT substr(o_orderpriority, 1, 1) || CASE o_orderstatus WHEN 'F' THEN 'x' ELSE '' END AS code,
         strftime(o_orderdate, '%Y-%m-') || CASE o_orderstatus WHEN 'P' THEN '40' ELSE '28' END AS day,
         CAST(o_totalprice AS VARCHAR) AS price
  FROM orders)
SELECT 'code' AS "column", count(*) FILTER (code IS NOT NULL AND TRY_CAST(code AS INTEGER) IS NULL) AS failed FROM s
UNION ALL SELECT 'day', count(*) FILTER (day IS NOT NULL AND TRY_CAST(day AS DATE) IS NULL) FROM s
UNION ALL SELECT 'price', count(*) FILTER (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) FROM s
""")
def cast_failures_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: values lost to casts, per column."""
    status = F.col("o_orderstatus")
    raw = load(spark, sf_dir, "orders").select(
        F.concat(F.substring("o_orderpriority", 1, 1), F.when(status == "F", "x").otherwise("")).alias("code"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.when(status == "P", "40").otherwise("28")).alias("day"),
        F.col("o_totalprice").cast("string").alias("price"),
    )
    typed = Table("orders", "silver", (Column("code", "integer"), Column("day", "date"), Column("price", "double")))
    return cast_failures(raw, typed)


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (o_orderstatus <> 'P') AS accepted,
       count(*) FILTER (o_orderstatus = 'P') AS rejected
FROM orders GROUP BY 1
""")
def required_columns_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: orders whose required status is set or not (pending orders are delivered without one)."""
    table = Table("orders", "silver", (Column("o_orderkey", "long", False), Column("status", "string", False)))
    raw = load(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    ok, rejected = enforce_required(raw, table)
    both = ok.withColumn("ok", F.lit(True)).unionByName(rejected.withColumn("ok", F.lit(False)))
    return both.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected")
    )


@query(MESH_SQL + """,
e AS (SELECT product, tier || '.' || tname AS tname, 'c' || j AS col, ctype, nullable FROM c),
a AS (SELECT product, tier || '.' || tname AS tname, CASE WHEN j = m AND n % 4 = 0 THEN 'c9' ELSE 'c' || j END AS col,
             CASE WHEN k % 5 = j THEN 'string' ELSE ctype END AS ctype,
             CASE WHEN n % 3 = i THEN nullable ELSE true END AS nullable
      FROM c),
b AS (SELECT coalesce(e.product, a.product) AS product, coalesce(e.tname, a.tname) AS "table",
             coalesce(e.col, a.col) AS "column", e.product IS NULL AS added, a.product IS NULL AS removed,
             e.ctype AS et, a.ctype AS actual_type, CASE WHEN e.nullable THEN 'nullable' ELSE 'required' END AS en,
             CASE WHEN a.nullable THEN 'nullable' ELSE 'required' END AS an
      FROM e FULL JOIN a ON e.product = a.product AND e.tname = a.tname AND e.col = a.col)
SELECT product, "table", "column", 'added' AS change, CAST(NULL AS VARCHAR) AS expected, actual_type AS actual FROM b WHERE added
UNION ALL SELECT product, "table", "column", 'removed', et, NULL FROM b WHERE removed
UNION ALL SELECT product, "table", "column", 'type', et, actual_type FROM b WHERE NOT added AND NOT removed AND et <> actual_type
UNION ALL SELECT product, "table", "column", 'nullability', en, an FROM b WHERE NOT added AND NOT removed AND en <> an
""")
def schema_drift_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the columns every contract declares against the columns its tables have."""
    customers = load(spark, sf_dir, "customer")
    nation, key = F.col("nation"), F.col("key")
    tables = contract_corpus(customers, "c_custkey", "c_nationkey").select(
        "product", F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"),
        F.posexplode_outer("tables").alias("i", "t"),
    ).where(F.col("i").isNotNull())
    declared = tables.select("product", "key", "nation", "i", "t", F.posexplode("t.columns").alias("j0", "c"))
    j = F.col("j0") + 1
    # Names by tier and position, since some of these contracts repeat a table or column name.
    table, column = F.concat_ws(".", "t.tier", "t.name").alias("table"), F.concat(F.lit("c"), j)
    expected = declared.select(
        "product", table, column.alias("column"),
        F.col("c.type").alias("type"), F.col("c.nullable").alias("nullable"),
    )
    renamed = (j == F.size("t.columns")) & (nation % 4 == 0)
    actual = declared.select(
        "product",
        table,
        F.when(renamed, "c9").otherwise(column).alias("column"),
        F.when(key % 5 == j, "string").otherwise(F.col("c.type")).alias("type"),
        F.when(nation % 3 == F.col("i"), F.col("c.nullable")).otherwise(True).alias("nullable"),
    )
    return schema_drift(expected, actual)


@query("""
WITH k AS (SELECT c_custkey % 6 AS v, 'c' || c_custkey AS "table" FROM customer)
SELECT 'p' AS product, "table", 'order.price' AS path, 'type' AS change, 'decimal(9,2)' AS expected, 'double' AS actual FROM k WHERE v = 1
UNION ALL SELECT 'p', "table", 'order.items.element.sku', 'moved', 'order.items.element.sku', 'order.sku' FROM k WHERE v = 2
UNION ALL SELECT 'p', "table", 'order', 'removed', 'struct', NULL FROM k WHERE v = 3
UNION ALL SELECT 'p', "table", 'note', 'type', 'string', 'struct' FROM k WHERE v = 4
UNION ALL SELECT 'p', "table", 'order.id', 'nullability', 'required', 'nullable' FROM k WHERE v = 5
""")
def schema_drift_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: a table per customer with nested columns, each changed in one place."""
    fields = [
        ("order", "struct", True), ("order.id", "bigint", False), ("order.price", "decimal(9,2)", True), ("order.items", "array", True),
        ("order.items.element", "struct", True), ("order.items.element.sku", "string", True), ("note", "string", True),
    ]
    entry = lambda path, kind, nullable: F.struct(
        F.lit(path).alias("path"), F.lit(path.rpartition(".")[0]).alias("parent"), F.lit(path.rpartition(".")[2]).alias("name"),
        F.lit(kind).alias("type"), F.lit(nullable).alias("nullable"),
    )
    way = F.col("c_custkey") % 6
    keys = load(spark, sf_dir, "customer").select("c_custkey", F.lit("p").alias("product"), F.concat(F.lit("c"), "c_custkey").alias("table"))
    expected = keys.select("product", "table", F.inline(F.array(*[entry(*f) for f in fields])))
    changed = keys.select("product", "table", way.alias("way"), F.explode(F.array(*[entry(*f) for f in fields])).alias("f"))
    path, at = F.col("f.path"), lambda w, p: (F.col("way") == w) & (path == p)
    actual = changed.where(~at(2, "order.items.element.sku") & ~((F.col("way") == 3) & path.startswith("order"))).select(
        "product", "table", path.alias("path"), "f.parent", "f.name",
        F.when(at(1, "order.price"), "double").when(at(4, "note"), "struct").otherwise(F.col("f.type")).alias("type"),
        F.when(at(5, "order.id"), True).otherwise(F.col("f.nullable")).alias("nullable"),
    )
    more = keys.withColumn("way", way).select(
        "product", "table", F.when(F.col("way") == 2, entry("order.sku", "string", True)).when(F.col("way") == 4, entry("note.text", "string", True)).alias("f")
    )
    return path_drift(expected, actual.union(more.where("f IS NOT NULL").select("product", "table", "f.*")))
