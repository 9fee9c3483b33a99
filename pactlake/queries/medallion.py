from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.operators.layout import read_partitioned
from pactlake.operators.medallion import deduplicate, latest_state, standardise, standardise_marked, write_snapshot
from pactlake.operators.quality import BROKEN
from pactlake.plans.customers import customer_summary
from pactlake.plans.orders import order_facts
from pactlake.plans.tiers import run_product
from pactlake.queries.registry import AS_OF, contract, load, private_copy, query
from pactlake.session import fresh_folder
from pactlake.sources.readers import ingest

LATEST_LINES_SQL = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1
"""


@query(LATEST_LINES_SQL)
def silver_lineitem_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest delivery of every order line."""
    return deduplicate(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(
        spark, f"{sf_dir}/customer.parquet", contract("retail_customers").table("raw_customers"),
        rename={"customer_id": "c_custkey", "full_name": "c_name", "nation_key": "c_nationkey",
                "balance": "c_acctbal", "market": "c_mktsegment"},
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(
        spark, f"{sf_dir}/orders.parquet", contract("retail_customers").table("raw_orders"),
        rename={"order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus",
                "total": "o_totalprice", "created_at": "o_orderdate"},
    )


def messy_customers(raw: DataFrame, nation: DataFrame) -> DataFrame:
    """Messy names and market codes on the way in: padding, lower case and blanks."""
    named = raw.join(nation.select(F.col("n_nationkey").alias("nation_key"), "n_name"), "nation_key", "left")
    return named.select(
        "customer_id",
        F.concat(F.lit("  "), F.lower("full_name"), F.lit(" ")).alias("full_name"),
        F.lower("n_name").alias("country_code"),
        F.when(F.col("market") == "MACHINERY", "  ").otherwise(F.lower("market")).alias("market"),
    )


CODES = ("full_name", "country_code", "market")


def silver_customers(raw: DataFrame, nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    return standardise(messy_customers(raw, nation), contract("retail_customers").table("customers"), CODES)


def marked_customers(raw: DataFrame, nation: DataFrame) -> DataFrame:
    """As `silver_customers`, and customers of nation 5 delivered without a name, which are to be rejected."""
    messy = messy_customers(raw, nation).withColumn(
        "full_name", F.when(F.lower("country_code") != "ethiopia", F.col("full_name"))
    )
    return standardise_marked(messy, contract("retail_customers").table("customers"), CODES)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(c_name) AS full_name, upper(n_name) AS country_code,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS market
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def silver_customer_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed, upper-cased, blanks to NULL, invalid rows out."""
    return silver_customers(raw_customers(spark, sf_dir), load(spark, sf_dir, "nation"))[0]


@query("""
SELECT o_orderstatus AS status, 'accepted_values:status' AS broken, count(*) AS n
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
""")
def silver_orders_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected side of a standardised table, with reasons."""
    from pactlake.contract import Column, Rule, Table

    table = Table(
        "orders", "silver", (Column("order_id", "string", False), Column("status", "string")),
        rules=(Rule("not_null", ("order_id",)), Rule("accepted_values", ("status",), {"values": ["F", "O"]})),
    )
    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("status")
    )
    _, bad = standardise(raw, table, codes=("status",))
    return bad.groupBy("status", F.array_join(BROKEN, ",").alias("broken")).agg(F.count(F.lit(1)).alias("n"))


def summary_sql(as_of: str) -> str:
    return f"""
SELECT *, CASE WHEN last_order_at IS NULL OR last_order_at < TIMESTAMP '{as_of}' - INTERVAL 365 DAY THEN 'churned'
               WHEN first_order_at >= TIMESTAMP '{as_of}' - INTERVAL 365 DAY THEN 'new'
               WHEN total_spend >= 3000000 THEN 'high_value' WHEN total_spend >= 1500000 THEN 'mid_value'
               ELSE 'low_value' END AS customer_segment, '{as_of[:10]}' AS as_of_date
FROM (SELECT CAST(c_custkey AS VARCHAR) AS customer_id, upper(c_name) AS full_name, upper(n_name) AS country_code,
             count(o_orderkey) AS total_orders,
             CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_spend,
             min(o_orderdate) AS first_order_at, max(o_orderdate) AS last_order_at
      FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
           LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate <= TIMESTAMP '{as_of}'
      GROUP BY c_custkey, c_name, n_name)
"""


def summary(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    customers, _ = silver_customers(raw_customers(spark, sf_dir), load(spark, sf_dir, "nation"))
    return customer_summary(customers.drop("market"), raw_orders(spark, sf_dir), as_of)


@query(summary_sql(AS_OF))
def gold_customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with counts, spend, dates and segment."""
    return summary(spark, sf_dir, AS_OF).withColumns(
        {"total_spend": F.col("total_spend").cast("double"), "as_of_date": F.col("as_of_date").cast("string")}
    )


@query(f"""
WITH s AS ({summary_sql('1999-06-30 00:00:00')})
SELECT customer_segment, count(*) AS customers, CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM s GROUP BY 1
""")
def gold_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: customers and spend per segment at an earlier day."""
    return summary(spark, sf_dir, "1999-06-30 00:00:00").groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_spend").cast("double").alias("spend")
    )


FACTS_SQL = f"""
WITH l AS ({LATEST_LINES_SQL}),
s AS (SELECT l_orderkey, count(*) AS item_count, max(l_shipdate) AS updated_at,
             sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS net,
             sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                 * CAST(l_tax AS DECIMAL(4,2))) AS tax
      FROM l GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'confirmed' WHEN 'P' THEN 'pending' END AS status,
       CAST(coalesce(item_count, 0) AS INTEGER) AS item_count,
       CAST(CAST(coalesce(net, 0) AS DECIMAL(18,2)) AS DOUBLE) AS subtotal,
       CAST(CAST(coalesce(tax, 0) AS DECIMAL(18,2)) AS DOUBLE) AS tax,
       CAST(CAST(coalesce(net + tax, 0) AS DECIMAL(18,2)) AS DOUBLE) AS total,
       o_orderdate AS created_at, coalesce(updated_at, o_orderdate) AS updated_at
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
"""


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest delivery of each line, in the names and decimals the facts are computed from."""
    latest = deduplicate(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return latest.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.col("l_shipdate").alias("changed_at"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )
    return order_facts(orders, order_lines(spark, sf_dir)).withColumn("order_id", F.col("order_id").cast("string"))


@query(FACTS_SQL)
def gold_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its amounts; orders without lines are kept."""
    amounts = ("subtotal", "tax", "total")
    return facts(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in amounts})


@query("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's newest event."""
    return latest_state(load(spark, sf_dir, "events"), ["user_id"], "ts", "event_id")


SNAPSHOT_DAYS = ("1998-01-31 00:00:00", "1999-01-31 00:00:00", "2000-01-31 00:00:00")


@query(
    "WITH s AS (" + "\nUNION ALL\n".join(f"SELECT * FROM ({summary_sql(d)})" for d in SNAPSHOT_DAYS) + """)
SELECT substr(as_of_date, 1, 7) AS month, customer_segment, count(*) AS customers,
       CAST(sum(total_orders) AS BIGINT) AS orders, CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS spend
FROM s GROUP BY 1, 2
""")
def gold_snapshot_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot per month; the last month is first written too early and then replaced."""
    table = contract("retail_customers").table("customer_summary")
    folder = fresh_folder(spark, "snapshots")
    for day in ("2000-01-15 00:00:00", *SNAPSHOT_DAYS):
        write_snapshot(summary(spark, sf_dir, day), table, folder)
    stored = read_partitioned(spark, table, folder)
    return stored.groupBy(F.col("__p_as_of_date_month").alias("month"), "customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_orders").alias("orders"),
        F.sum("total_spend").cast("double").alias("spend"),
    )


@query("""
WITH n AS (SELECT n_nationkey AS k FROM nation WHERE n_name = 'ETHIOPIA')
SELECT 'bronze' AS tier, 'raw_customers' AS "table", 'passed' AS status, count(*) AS "rows", CAST(0 AS BIGINT) AS rejected,
       CAST(0 AS BIGINT) AS failed_rules, CAST(NULL AS VARCHAR) AS error
FROM customer
UNION ALL SELECT 'bronze', 'raw_orders', 'passed', count(*), 0, 0, NULL FROM orders
UNION ALL SELECT 'silver', 'customers', 'passed', count(*) FILTER (c_nationkey NOT IN (SELECT k FROM n)),
       count(*) FILTER (c_nationkey IN (SELECT k FROM n)), 0, NULL FROM customer
UNION ALL SELECT 'gold', 'customer_summary', 'passed', count(*) FILTER (c_nationkey NOT IN (SELECT k FROM n)), 0, 0, NULL
FROM customer
""")
def tiers_retail_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze to gold through stored tables, every gate passed; rejected customers are stored and counted."""
    nation = load(spark, sf_dir, "nation")
    builds = {
        "raw_customers": lambda _: raw_customers(spark, sf_dir),
        "raw_orders": lambda _: raw_orders(spark, sf_dir),
        "customers": lambda t: marked_customers(t["raw_customers"], nation),
        "customer_summary": lambda t: customer_summary(t["customers"], t["raw_orders"], AS_OF),
    }
    product = private_copy(contract("retail_customers"))
    return run_product(spark, product, builds, fresh_folder(spark, "tiers"), AS_OF).drop("product")


@query("""
SELECT 'bronze' AS tier, 'raw_orders' AS "table", 'failed' AS status, count(*) AS "rows", CAST(0 AS BIGINT) AS rejected,
       CAST(NULL AS VARCHAR) AS error, CAST(max(CASE WHEN o_totalprice < 1000 THEN 1 ELSE 0 END) + max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END)
         + max(CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END)
         + CASE WHEN count(*) > count(DISTINCT o_custkey) THEN 1 ELSE 0 END AS BIGINT) AS failed_rules
FROM orders
UNION ALL SELECT 'bronze', 'raw_lines', 'passed', count(*), 0, NULL, 0 FROM lineitem
UNION ALL SELECT 'gold', 'order_facts', 'blocked', 0, 0, NULL, 0
""")
def tiers_retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders break their rules, so the facts built on them are not computed."""
    product = private_copy(contract("retail_orders"))
    source = lambda name: lambda _: load(spark, sf_dir, name)
    builds = {
        "raw_orders": source("orders"), "raw_lines": source("lineitem"), "order_facts": lambda _: facts(spark, sf_dir),
    }
    return run_product(spark, product, builds, fresh_folder(spark, "tiers"), AS_OF).drop("product")
