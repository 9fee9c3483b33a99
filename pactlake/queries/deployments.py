from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.operators import deployments as d
from pactlake.queries.registry import load, query
from pactlake.session import fresh_folder

LOG_SQL = """
WITH log AS (
  SELECT 'customer_' || o_custkey AS product, '1.' || year(o_orderdate) || '.' || month(o_orderdate) AS version,
         o_orderdate AS deployed_at, o_orderkey AS sequence, o_orderpriority = '1-URGENT' AS deleted,
         o_orderstatus AS st, o_totalprice AS price, o_orderpriority AS prio,
         CASE WHEN o_totalprice > 100000 THEN 2 ELSE 1 END AS tables,
         CASE WHEN o_orderstatus = 'F' THEN 'partial' ELSE 'success' END AS status,
         CASE WHEN o_orderstatus = 'F' THEN 'registry: unavailable' ELSE '' END AS errors
  FROM orders),
newest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY deployed_at DESC, sequence DESC) AS rn FROM log)
  WHERE rn = 1),
latest AS (SELECT * FROM newest WHERE NOT deleted)
"""


def deployment_log(orders: DataFrame) -> DataFrame:
    """One deployment per order: the customer is the product, the day the moment, an urgent order a deletion."""
    name = F.concat(F.lit("customer_"), "o_custkey")
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")

    def table(short: str, tier: str):
        made = F.array(
            F.when(status != "F", "table"), F.when(status != "P", "suite"), F.when(priority != "5-LOW", "model")
        )
        return F.struct(F.lit(short).alias("name"), F.lit(tier).alias("tier"), F.array_compact(made).alias("resources"))

    small, both = F.array(table("raw", "bronze")), F.array(table("raw", "bronze"), table("facts", "gold"))
    return orders.select(
        name.alias("product"),
        F.concat_ws(".", F.lit("1"), F.year("o_orderdate"), F.month("o_orderdate")).alias("version"),
        F.col("o_orderdate").alias("deployed_at"),
        F.col("o_orderkey").alias("sequence"),
        name.alias("namespace"),
        F.to_json(F.when(price > 100000, both).otherwise(small)).alias("tables_json"),
        F.when(status == "F", '["registry: unavailable"]').otherwise("[]").alias("errors_json"),
        (priority == "1-URGENT").alias("deleted"),
    )


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deployment_log(load(spark, sf_dir, "orders"))


@query(LOG_SQL + "SELECT product, version, deployed_at, sequence FROM latest")
def deployments_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H4: what is deployed now; the log is appended in two parts."""
    log, folder = _log(spark, sf_dir), fresh_folder(spark, "deployments")
    d.append(log.where("deployed_at < '1999-01-01'"), folder)
    d.append(log.where("deployed_at >= '1999-01-01'"), folder)
    stored = spark.read.schema(d.LOG_SCHEMA).parquet(folder)
    return d.latest(stored).select("product", "version", "deployed_at", "sequence")


@query(LOG_SQL + "SELECT product, version, deployed_at, status, errors FROM latest WHERE product = 'customer_5'")
def deployments_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2"""
    return d.listing(d.get(_log(spark, sf_dir), "customer_5")).drop("tables")


@query(LOG_SQL + "SELECT product, version, deployed_at, CAST(tables AS BIGINT) AS tables, status, errors FROM latest")
def deployments_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2, H3, H7"""
    return d.listing(d.latest(_log(spark, sf_dir))).withColumn("tables", F.col("tables").cast("long"))


@query(LOG_SQL + """
SELECT status, count(*) AS products, CAST(sum(tables) AS BIGINT) AS tables, count(*) FILTER (errors <> '') AS with_errors
FROM latest GROUP BY 1
""")
def deployments_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7"""
    return d.listing(d.latest(_log(spark, sf_dir))).groupBy("status").agg(
        F.count(F.lit(1)).alias("products"), F.sum("tables").alias("tables"),
        F.count_if(F.col("errors") != "").alias("with_errors"),
    )


@query(LOG_SQL + "SELECT product, version, deployed_at FROM latest WHERE status <> 'partial'")
def deployments_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: products with a partial deployment are deleted by appending tombstones."""
    folder = fresh_folder(spark, "tombstones")
    log = _log(spark, sf_dir)
    d.append(log, folder)
    broken = d.latest(log).where(d.status(F.from_json("errors_json", "array<string>")) == "partial")
    d.append(d.tombstones(broken, F.col("deployed_at") + F.make_dt_interval(days=F.lit(1))), folder)
    return d.latest(spark.read.schema(d.LOG_SCHEMA).parquet(folder)).select("product", "version", "deployed_at")


@query(LOG_SQL + """
SELECT product, x.name AS "table", x.tier AS tier, st <> 'F' AS registered, st <> 'P' AS suite, prio <> '5-LOW' AS model
FROM latest, (VALUES ('raw', 'bronze', 1), ('facts', 'gold', 2)) x(name, tier, pos) WHERE pos <= tables
""")
def deployments_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5"""
    return d.resource_matrix(d.latest(_log(spark, sf_dir)))


@query(LOG_SQL + """,
requests AS (SELECT 'customer_' || c_custkey AS product, '1.2001.' || (c_nationkey % 8 + 1) AS version,
                    c_acctbal > 5000 AS force FROM customer)
SELECT q.product, q.version, q.force, latest.version AS deployed_version,
       q.force OR coalesce(q.version <> latest.version, true) AS deploy
FROM requests q LEFT JOIN latest USING (product)
""")
def deployments_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6"""
    requests = load(spark, sf_dir, "customer").select(
        F.concat(F.lit("customer_"), "c_custkey").alias("product"),
        F.concat(F.lit("1.2001."), F.col("c_nationkey") % 8 + 1).alias("version"),
        (F.col("c_acctbal") > 5000).alias("force"),
    )
    return d.redeploy_gate(requests, d.latest(_log(spark, sf_dir)))
