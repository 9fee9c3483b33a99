from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Rule, Table
from pactlake.operators.quality import breaks
from pactlake.operators.sla import (
    availability, expire_partitions, freshness_lag, quality_trend, row_count_bounds, unexpired,
)
from pactlake.plans.deploy import service_levels
from pactlake.queries.registry import AS_OF, EVENTS_AS_OF, contract, load, private_copy, query
from pactlake.session import fresh_folder
from pactlake.sources.readers import read_table
from pactlake.sources.writers import write_table


#: Table, its time, the contract that promises its freshness, and when it is measured.
MEASURED = (
    ("orders", "o_orderdate", "retail_customers", AS_OF), ("lineitem", "l_shipdate", "retail_orders", AS_OF),
    ("events", "ts", "site_events", EVENTS_AS_OF),
)


@query("\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", max({c}) AS newest,"
    f" CAST(trunc((epoch_us(TIMESTAMP '{at}') - epoch_us(max({c}))) / 60e6) AS BIGINT) AS lag_minutes,"
    f" max({c}) < TIMESTAMP '{at}' - INTERVAL {contract(p).freshness_hours} HOUR AS breached FROM {t}"
    for t, c, p, at in MEASURED))
def sla_freshness_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whole minutes behind, per table, against what the contracts promise; data from after the moment of measurement
    gives a negative lag."""
    lags = [
        freshness_lag({t: (load(spark, sf_dir, t), c)}, at, contract(p).freshness_hours) for t, c, p, at in MEASURED
    ]
    return reduce(DataFrame.unionByName, lags)


BOUNDED = ("customer", "orders", "lineitem", "events", "pages")


@query("\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", count(*) AS row_count, count(*) BETWEEN 1000 AND 20000 AS passed FROM {t}"
    for t in BOUNDED))
def sla_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3"""
    return row_count_bounds({t: load(spark, sf_dir, t) for t in BOUNDED}, 1000, 20000)


@query(f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY
""")
def retention_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the rows that stay; 24 hours of freshness keep bronze data for seven days."""
    return unexpired(load(spark, sf_dir, "events"), "ts", EVENTS_AS_OF, contract("site_events").bronze_retention_days)


@query(f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY GROUP BY 1
""")
def retention_partitions_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """expired partitions dropped by name from a table kept by day."""
    product = private_copy(contract("site_events"))
    by_day = replace(product.table("raw_events"), partitions=(Partition("ts", "day"),))
    product = replace(product, tables=(by_day,))
    write_table(load(spark, sf_dir, "events"), product, "raw_events", fresh_folder(spark, "retention"))
    expire_partitions(spark, product, "raw_events", EVENTS_AS_OF)
    stored = read_table(spark, product, "raw_events")
    return stored.groupBy(F.col("__p_ts_day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def availability_sql(source: str, group: str, at: str, start: str, hours: str, bound: int, target: float) -> str:
    """`start` and `hours` are SQL. The state at each hour's end, laid out hour by hour."""
    return f"""
WITH spine AS (
  SELECT {group}, {start} + to_hours(CAST(i AS INTEGER)) AS h
  FROM (SELECT DISTINCT {group} FROM {source}), (SELECT unnest(range({hours})) AS i)),
a AS (SELECT {group}, {start} + to_hours(CAST(greatest(floor((epoch({at}) - epoch({start})) / 3600), 0) AS INTEGER)) AS h,
        max({at}) AS newest FROM {source} GROUP BY 1, 2),
j AS (SELECT {group}, spine.h, last_value(newest IGNORE NULLS) OVER (PARTITION BY {group} ORDER BY spine.h
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM spine LEFT JOIN a USING ({group}, h)),
f AS (SELECT {group}, coalesce(epoch(h + INTERVAL 1 HOUR - seen) <= {bound} * 3600, false) AS fresh FROM j)
SELECT {group}, count(*) AS hours, count(*) FILTER (fresh) AS fresh_hours,
       round(100.0 * count(*) FILTER (fresh) / count(*), 4) AS availability_pct,
       round(100.0 * count(*) FILTER (fresh) / count(*), 4) >= {target} AS met
FROM f GROUP BY 1
"""


EVENTS_PCT = contract("site_events").availability_pct


@query(availability_sql("events", "event_type", "ts", "TIMESTAMP '2024-01-02 12:00:00'", "684", 1, EVENTS_PCT))
def sla_availability_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hours of January, from the second day's noon on, at whose end the newest event of a type was at most an hour old."""
    return availability(
        load(spark, sf_dir, "events"), "event_type", "ts", "2024-01-02 12:00:00", 684, 1, EVENTS_PCT
    )


@query(availability_sql("events", "event_type", "ts", "TIMESTAMP '2024-01-02 12:30:20'", "500", 1, EVENTS_PCT))
def sla_availability_half_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the same over hours that begin at half past and twenty seconds."""
    return availability(load(spark, sf_dir, "events"), "event_type", "ts", "2024-01-02 12:30:20", 500, 1, EVENTS_PCT)


@query(availability_sql(
    "orders", "o_orderstatus", "o_orderdate", "(SELECT date_trunc('day', min(o_orderdate)) FROM orders)",
    "(SELECT 24 * (date_diff('day', min(o_orderdate), max(o_orderdate)) + 1) FROM orders)", 4, 15.0))
def sla_availability_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders come once a day, so only the first hours of a day are within four hours; over all days of the data."""
    orders = load(spark, sf_dir, "orders")
    first, last = orders.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    hours = 24 * ((last - first).days + 1)
    return availability(orders, "o_orderstatus", "o_orderdate", f"{first} 00:00:00", hours, 4, 15.0)


@query("""
WITH r AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS run_date, unnest([
           CASE WHEN count(*) FILTER (o_totalprice > 499000) = 0 THEN 1 ELSE 0 END,
           CASE WHEN count(*) FILTER (o_totalprice < 1500) = 0 THEN 1 ELSE 0 END,
           CASE WHEN count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) = 0 THEN 1 ELSE 0 END]) AS ok
  FROM orders GROUP BY 1),
g AS (SELECT run_date, count(*) AS checks, CAST(sum(ok) AS BIGINT) AS passed_checks,
             round(sum(ok) / count(*), 6) AS pass_rate FROM r GROUP BY 1)
SELECT 'retail' AS product, 'orders' AS "table", run_date, checks, passed_checks, pass_rate,
       round(pass_rate - lag(pass_rate) OVER (ORDER BY run_date), 6) AS change
FROM g
""")
def quality_trend_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the checks of every month as one run, and how the pass rate moves."""
    table = Table("orders", "bronze", (Column("o_totalprice", "double"), Column("o_orderstatus", "string")))
    rules = (
        (Rule("max_value", params={"max": 499000}), "o_totalprice"),
        (Rule("min_value", params={"min": 1500}), "o_totalprice"),
        (Rule("accepted_values", params={"values": ["F", "O", "P"]}), "o_orderstatus"),
    )
    counted = load(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("run_date")).agg(
        *[F.count_if(breaks(r, c, table)).alias(r.kind) for r, c in rules]
    )
    results = counted.select(
        F.lit("retail").alias("product"), F.lit("orders").alias("table"), "run_date",
        F.explode(F.array(*[F.col(r.kind) == 0 for r, _ in rules])).alias("passed"),
    )
    return quality_trend(results)


#: A moment inside the data, not on the hour.
MOMENT = "2000-07-31 12:30:00"


@query(f"""
WITH o AS (SELECT * FROM orders), j AS (
  SELECT epoch(h + INTERVAL 1 HOUR - (SELECT max(o_orderdate) FROM o WHERE o_orderdate < h + INTERVAL 1 HOUR)) <= 24 * 3600 AS fresh
  FROM (SELECT TIMESTAMP '{MOMENT}' - INTERVAL 720 HOUR + to_hours(CAST(i AS INTEGER)) AS h FROM range(720) x(i)))
SELECT 'retail_customers' AS product, 'raw_customers' AS "table", 'row_count' AS promise, CAST(count(*) AS DOUBLE) AS measured,
       count(*) >= 100 AS met FROM customer
UNION ALL SELECT 'retail_customers', 'raw_orders', 'row_count', CAST(count(*) AS DOUBLE), count(*) >= 100 FROM o
UNION ALL SELECT 'retail_customers', 'raw_orders', 'freshness',
       CAST(trunc((epoch_us(TIMESTAMP '{MOMENT}') - epoch_us(max(o_orderdate))) / 60e6) AS DOUBLE),
       max(o_orderdate) >= TIMESTAMP '{MOMENT}' - INTERVAL 24 HOUR FROM o WHERE o_orderdate <= TIMESTAMP '{MOMENT}'
UNION ALL SELECT 'retail_customers', 'raw_orders', 'availability', round(100.0 * count(*) FILTER (fresh) / 720, 4),
       round(100.0 * count(*) FILTER (fresh) / 720, 4) >= 99.9 FROM j
""")
def sla_contract_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the promises of a contract, with its own bounds, over the last thirty days before a moment in the past."""
    from pactlake.queries.medallion import raw_customers, raw_orders

    tables = {"raw_customers": raw_customers(spark, sf_dir), "raw_orders": raw_orders(spark, sf_dir)}
    return service_levels(tables, contract("retail_customers"), MOMENT, hours=720)
