from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import Column, Table
from pactlake.queries.registry import contract, load, private_copy, query
from pactlake.session import fresh_folder
from pactlake.sources.readers import ingest, read_table
from pactlake.sources.writers import create_table, drop_product, write_table

PARTS = Table(
    "raw_parts", "bronze",
    (
        Column("p_partkey", "long", False), Column("p_brand", "string"), Column("p_size", "integer"),
        Column("p_retailprice", "decimal", precision=10, scale=2), Column("p_added", "date"),
    ),
)
PARTS_SQL = """
SELECT p_partkey, p_brand, p_size, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS p_retailprice,
       CAST(NULL AS VARCHAR) AS p_added FROM part
"""


def _through(spark: SparkSession, sf_dir: str, format: str, where: str | None = None) -> DataFrame:
    folder = fresh_folder(spark, format)
    load(spark, sf_dir, "part").write.format(format).options(**({"header": True} if format == "csv" else {})).save(folder)
    parts = ingest(spark, folder, PARTS, format, where=where)
    return parts.withColumns(
        {"p_retailprice": F.col("p_retailprice").cast("double"), "p_added": F.col("p_added").cast("string")}
    )


@query(PARTS_SQL)
def ingest_csv_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: CSV, read as text and cast to the contract."""
    return _through(spark, sf_dir, "csv")


@query(PARTS_SQL + " WHERE p_size > 20")
def ingest_json_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: JSON lines with names and a filter of their own."""
    folder = fresh_folder(spark, "json")
    load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"), F.col("p_brand").alias("BRAND"), F.col("p_size").alias("extent"), F.col("p_retailprice").alias("price")
    ).write.json(folder)
    parts = ingest(
        spark, folder, PARTS, "json", where="CAST(extent AS INT) > 20", schema="key string, BRAND string, extent string, price string",
        rename={"p_partkey": "key", "p_brand": "brand", "p_size": "extent", "p_retailprice": "price"},
    )
    return parts.withColumns(
        {"p_retailprice": F.col("p_retailprice").cast("double"), "p_added": F.col("p_added").cast("string")}
    )


@query(PARTS_SQL + " WHERE p_size > 20 AND p_brand <> 'Brand#1'")
def ingest_orc_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: ORC with a source filter."""
    return _through(spark, sf_dir, "orc", "p_size > 20 AND p_brand <> 'Brand#1'")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name, c_nationkey AS nation_key, c_acctbal AS balance,
       c_mktsegment AS market FROM customer WHERE c_acctbal >= 1000
""")
def ingest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet source under other names; the filter reaches the scan."""
    return ingest(
        spark, f"{sf_dir}/customer.parquet", contract("retail_customers").table("raw_customers"),
        where="c_acctbal >= 1000",
        rename={"customer_id": "c_custkey", "full_name": "c_name", "nation_key": "c_nationkey",
                "balance": "c_acctbal", "market": "c_mktsegment"},
    )


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE year(o_orderdate) = 2000) GROUP BY 1
""")
def tier_table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespace and table made once, rows appended, read back by name."""
    product, root = private_copy(contract("retail_orders")), fresh_folder(spark, "lake")
    orders = load(spark, sf_dir, "orders")
    write_table(orders, product, "raw_orders", root)
    create_table(spark, product, product.table("raw_orders"), root)
    write_table(orders.where(F.year("o_orderdate") == 2000), product, "raw_orders", root)
    return read_table(spark, product, "raw_orders").groupBy(F.col("__p_o_orderdate_month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("double").alias("total")
    )


@query("""
SELECT o_orderstatus, count(*) AS n, CAST(1 AS INTEGER) AS dropped, CAST(0 AS INTEGER) AS dropped_again
FROM orders GROUP BY 1
""")
def drop_and_adopt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropping a product leaves its files; making the table again finds their partitions."""
    product, root = private_copy(contract("retail_orders")), fresh_folder(spark, "lake")
    write_table(load(spark, sf_dir, "orders"), product, "raw_orders", root)
    dropped, again = drop_product(spark, product), drop_product(spark, product)
    create_table(spark, product, product.table("raw_orders"), root)
    return read_table(spark, product, "raw_orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.lit(dropped).alias("dropped"), F.lit(again).alias("dropped_again")
    )


@query("""
SELECT strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m') AS month, o_orderstatus, count(*) AS n FROM orders
WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2
""")
def tier_rebuild_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is rebuilt by a later version of its contract: rows have moved to other partitions or gone, and
    the columns are declared in another order. A second rebuild fails in a task; it leaves the rows of the first."""
    product, root = private_copy(contract("retail_orders")), fresh_folder(spark, "lake")
    orders = load(spark, sf_dir, "orders")
    write_table(orders, product, "raw_orders", root)
    table = product.table("raw_orders")
    later = replace(product, tables=(replace(table, columns=table.columns[::-1]),))
    moved = orders.where("o_orderkey % 3 <> 0").withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 40 DAY"))
    write_table(moved, later, "raw_orders", root, mode="rebuild")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    broken = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("a broken row"))).otherwise(F.col("o_custkey")))
    try:
        write_table(broken, later, "raw_orders", root, mode="rebuild")
    except Exception as e:
        if "a broken row" not in str(e):
            raise
    else:
        raise AssertionError("the broken rebuild went through")
    return read_table(spark, later, "raw_orders").groupBy(
        F.col("__p_o_orderdate_month").alias("month"), "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT v.version, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN v.version = 3 AND year(o_orderdate) = 1999 THEN 2 ELSE 1 END) AS DOUBLE) AS total
FROM orders, (VALUES (1), (2), (3), (4)) v(version)
WHERE (v.version > 1 OR o_orderkey % 2 = 0) AND NOT (v.version = 4 AND o_orderstatus = 'F') GROUP BY 1, 2
""")
def versions_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of a table, each read back after all were written: half of the rows, the other half appended, the
    months of a year replaced, and the table rebuilt without a status."""
    product, root = private_copy(contract("retail_orders")), fresh_folder(spark, "lake")
    orders = load(spark, sf_dir, "orders")
    write_table(orders.where("o_orderkey % 2 = 0"), product, "raw_orders", root)
    write_table(orders.where("o_orderkey % 2 <> 0"), product, "raw_orders", root)
    doubled = orders.where(F.year("o_orderdate") == 1999).withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)") * 2)
    write_table(doubled, product, "raw_orders", root, mode="overwrite")
    write_table(orders.where("o_orderstatus <> 'F'"), product, "raw_orders", root, mode="rebuild")
    parts = [
        read_table(spark, product, "raw_orders", version).groupBy(F.col("__p_o_orderdate_month").alias("month"))
        .agg(F.lit(version).alias("version"), F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("double").alias("total"))
        for version in (1, 2, 3, 4)
    ]
    return reduce(DataFrame.unionByName, parts)
