from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import COLUMN_TYPES, EMAIL_PATTERN, IDENTIFIER_PATTERN, PRODUCT_NAME_PATTERN, VERSION_PATTERN
from pactlake.operators import governance as g
from pactlake.queries.mesh import MESH_SQL, contract_corpus, nation_contracts
from pactlake.queries.registry import load, query


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_corpus(load(spark, sf_dir, "customer"))


def _mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corpus(spark, sf_dir).unionByName(nation_contracts(load(spark, sf_dir, "nation")))


@query(MESH_SQL + """
SELECT product, tier, tname AS "table", cname AS "column", upper(ctype) AS type,
       CASE WHEN nullable THEN 'NONE' ELSE 'NOT_NULL' END AS "constraint", cdesc AS description FROM c
""")
def gov_column_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1"""
    return g.column_inventory(_corpus(spark, sf_dir))


@query(MESH_SQL + """
SELECT product, tname AS "table", count(*) FILTER (pii) AS pii_count,
       coalesce(string_agg(cname, ',' ORDER BY j) FILTER (pii), '') AS pii_columns,
       CASE WHEN bool_or(pii) THEN 'PII.Sensitive' END AS tag
FROM c GROUP BY product, i, tname
""")
def gov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2"""
    return g.pii_inventory(_corpus(spark, sf_dir)).withColumn("pii_count", F.col("pii_count").cast("long"))


@query(MESH_SQL + """
SELECT product, tname AS "table",
       array_to_string(list_transform(string_split(replace(tname, '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
         AS display_name,
       coalesce(tdesc, upper(tier[1]) || tier[2:] || ' tier table for ' || product) AS description
FROM t
""")
def gov_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3"""
    return g.table_labels(_corpus(spark, sf_dir))


@query(MESH_SQL + """,
teams AS (SELECT lower(c_mktsegment) AS team, min(c_custkey) AS team_id FROM customer
          WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
SELECT product, tname AS "table", team, team_id, team_id IS NOT NULL AS assigned
FROM t LEFT JOIN teams ON team = s
""".replace("product, tname AS \"table\", team,", "product, tname AS \"table\", s AS team,"))
def gov_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five teams own all products, one of them is unknown."""
    customers = load(spark, sf_dir, "customer")
    teams = customers.where("c_mktsegment <> 'MACHINERY'").groupBy(F.lower("c_mktsegment").alias("team")).agg(
        F.min("c_custkey").alias("team_id")
    )
    return g.owner_assignment(contract_corpus(customers), teams)


@query(MESH_SQL + """
SELECT product, tname AS "table", cname AS "column", array_to_string(list_sort(list_concat(
         ['segment:' || s, 'nation:' || n, 'tier:' || tier, 'pos:' || j], CASE WHEN pii THEN ['pii'] ELSE [] END)), ',')
         AS tags FROM c
""")
def gov_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5"""
    return g.propagated_tags(_corpus(spark, sf_dir)).withColumn("tags", F.array_join("tags", ","))


@query(MESH_SQL + """
SELECT c.product, c.tier, c.tname AS "table", count(*) AS columns,
       coalesce(string_agg(cname, ',' ORDER BY j) FILTER (pii), '') AS pii_columns, CAST(3 AS BIGINT) AS rules,
       max(s.transform || '(' || s.col || coalesce(', ' || s.size, '') || ')') AS partitioning
FROM c JOIN s ON s.product = c.product AND s.i = c.i GROUP BY c.product, c.i, c.tier, c.tname
""")
def gov_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6"""
    counts = ("columns", "rules")
    return g.product_summary(_corpus(spark, sf_dir)).withColumns({c: F.col(c).cast("long") for c in counts})


@query(MESH_SQL + """
SELECT c.product, c.tname AS "table", cname AS "column", coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind), '')
         AS rules, count(kind) = 0 AND NOT any_value(nullable) AS unguarded
FROM c LEFT JOIN r ON r.product = c.product AND r.i = c.i AND r.col = c.cname GROUP BY c.product, c.i, c.tname, j, cname
""")
def gov_rule_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7"""
    return g.rule_coverage(_corpus(spark, sf_dir))


LINT_SQL = MESH_SQL + f"""
SELECT product, '' AS "table", 'product' AS object, 'bad product name' AS violation FROM p
  WHERE NOT regexp_matches(product, '{PRODUCT_NAME_PATTERN}')
UNION ALL SELECT product, '', 'version', 'bad version' FROM p WHERE NOT regexp_matches(version, '{VERSION_PATTERN}')
UNION ALL SELECT product, '', 'owner', 'bad owner email' FROM p WHERE NOT regexp_matches(email, '{EMAIL_PATTERN}')
UNION ALL SELECT product, '', 'sla', 'freshness_hours out of range' FROM p WHERE freshness_hours NOT BETWEEN 1 AND 8760
UNION ALL SELECT product, '', 'sla', 'availability_pct out of range' FROM p WHERE availability_pct NOT BETWEEN 0 AND 100
UNION ALL SELECT product, tname, tname, 'duplicate table name' FROM t GROUP BY product, tname HAVING count(*) > 1
UNION ALL SELECT product, tname, tname, 'bad table name' FROM t WHERE NOT regexp_matches(tname, '{IDENTIFIER_PATTERN}')
UNION ALL SELECT product, tname, cname, 'duplicate column name' FROM c GROUP BY product, i, tname, cname HAVING count(*) > 1
UNION ALL SELECT product, tname, cname, 'bad column name' FROM c WHERE NOT regexp_matches(cname, '{IDENTIFIER_PATTERN}')
UNION ALL SELECT product, tname, cname, 'unknown type' FROM c WHERE NOT list_contains({list(COLUMN_TYPES)}, ctype)
UNION ALL SELECT product, tname, cname, 'decimal without precision and scale' FROM c WHERE ctype = 'decimal' AND NOT sized
UNION ALL SELECT product, tname, cname, 'struct without fields' FROM c WHERE ctype = 'struct' AND n = 4
UNION ALL SELECT product, tname, cname, 'no element type' FROM c WHERE ctype IN ('array', 'map') AND n = 20
UNION ALL SELECT product, tname, cname || '.element', 'no element type' FROM c WHERE ctype IN ('array', 'map') AND n = 21
UNION ALL SELECT product, tname, parent || '.' || fname, 'bad column name' FROM f WHERE NOT regexp_matches(fname, '{IDENTIFIER_PATTERN}')
UNION ALL SELECT product, tname, parent || '.' || fname, 'unknown type' FROM f WHERE NOT list_contains({list(COLUMN_TYPES)}, ftype)
UNION ALL SELECT product, tname, parent || '.' || fname, 'decimal without precision and scale' FROM f WHERE ftype = 'decimal' AND NOT sized
UNION ALL SELECT DISTINCT product, tname, tname, 'reads itself in a circle' FROM t WHERE n = 13 AND i = 1
UNION ALL SELECT product, tname, col, 'unknown transform' FROM s WHERE transform = 'week'
UNION ALL SELECT product, tname, col, 'bucket without num_buckets' FROM s WHERE transform = 'bucket' AND NOT size > 0
UNION ALL SELECT product, tname, col, 'truncate without width' FROM s WHERE transform = 'truncate'
UNION ALL SELECT product, tname, col, 'partition on unknown column' FROM s
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.product = s.product AND c.i = s.i AND c.cname = s.col)
UNION ALL SELECT product, tname, kind, 'unknown rule' FROM r WHERE kind = 'no_such_rule'
UNION ALL SELECT product, tname, kind, 'rule without its parameter' FROM r WHERE NOT complete
UNION ALL SELECT product, tname, col, 'rule on unknown column' FROM r
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.product = r.product AND c.i = r.i AND c.cname = r.col)
"""


@query(LINT_SQL)
def gov_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every validity rule over the corpus, duplicates and parameters included."""
    return g.lint(_corpus(spark, sf_dir))


EDGES_SQL = MESH_SQL + """,
edges AS (
  SELECT DISTINCT product || '.' || tname AS "table", input AS upstream FROM t
  UNION SELECT 'nation_' || n_nationkey || CASE WHEN n_nationkey < 20 THEN '.feed' ELSE '.other' END,
               'nation_' || n_nationkey || CASE WHEN n_nationkey < 20 THEN '.raw_feed' ELSE '.raw_other' END FROM nation)
"""


@query(EDGES_SQL + """SELECT "table", upstream FROM edges""")
def gov_lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct inputs; the nations' feeds declare none and fall back to names."""
    return g.lineage_edges(_mesh(spark, sf_dir))


@query(EDGES_SQL + """,
declared AS (SELECT product || '.' || tname AS name FROM t
             UNION SELECT 'nation_' || n_nationkey || CASE WHEN n_nationkey < 20 THEN '.feed' ELSE '.other' END FROM nation)
SELECT "table", upstream FROM edges WHERE upstream NOT IN (SELECT name FROM declared)
""")
def gov_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs nobody declares."""
    mesh = _mesh(spark, sf_dir)
    return g.dangling(g.lineage_edges(mesh), g.declared_tables(mesh))


@query(EDGES_SQL + """,
walk AS (
  SELECT "table", upstream, 1 AS distance, ["table", upstream] AS path FROM edges
  UNION SELECT walk."table", edges.upstream, walk.distance + 1, list_append(path, edges.upstream)
  FROM walk JOIN edges ON edges."table" = walk.upstream
  WHERE NOT list_contains(path[2:], edges.upstream))
SELECT "table", upstream, min(distance) AS distance FROM walk GROUP BY 1, 2
""")
def gov_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a table depends on; some products read themselves."""
    return g.all_upstream(g.lineage_edges(_mesh(spark, sf_dir)))


@query(EDGES_SQL + """,
walk AS (
  SELECT "table", upstream, 1 AS distance, ["table", upstream] AS path FROM edges
  UNION SELECT walk."table", edges.upstream, walk.distance + 1, list_append(path, edges.upstream)
  FROM walk JOIN edges ON edges."table" = walk.upstream
  WHERE NOT list_contains(path[2:], edges.upstream))
SELECT "table", min(distance) AS steps FROM walk WHERE "table" = upstream GROUP BY 1
""")
def gov_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that depend on themselves, and in how many steps."""
    return g.circles(g.lineage_edges(_mesh(spark, sf_dir)))


@query("""
WITH chain AS (SELECT c_custkey AS k, c_custkey // 250 AS chain, 'p.t' || c_custkey AS name FROM customer)
SELECT b.name AS "table", a.name AS upstream, CAST(b.k - a.k AS INTEGER) AS distance
FROM chain a JOIN chain b USING (chain) WHERE a.k < b.k
""")
def gov_upstream_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as chains of 250 tables, everything that each depends on."""
    return g.all_upstream(_chains(spark, sf_dir))


@query("""
WITH chain AS (SELECT c_custkey AS k, c_custkey // 250 AS chain, 'p.t' || c_custkey AS name FROM customer)
SELECT b.name AS "table", a.name AS upstream, CAST(b.k - a.k AS INTEGER) AS distance
FROM chain a JOIN chain b USING (chain) WHERE a.k < b.k AND b.k % 250 = 5
""")
def gov_upstream_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one table near the beginning of each chain depends on; the rest of the chains is not walked."""
    edges = _chains(spark, sf_dir)
    return g.upstream_of(edges, edges.where(F.regexp_extract("table", "[0-9]+", 0).cast("long") % 250 == 5))


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    named = lambda c: F.concat(F.lit("p.t"), c.cast("string"))
    customers = load(spark, sf_dir, "customer")
    first = customers.agg(F.min("c_custkey")).first()[0]
    keys = customers.select("c_custkey").where((key % 250 != 0) & (key > first))
    return keys.select(named(key).alias("table"), named(key - 1).alias("upstream"))


#: What lint says of rules and partitions, which are taken away from some contracts below.
_RULES_SQL = "violation LIKE '%rule%' OR violation LIKE '%partition%' OR violation LIKE '%transform%' OR violation LIKE '%num_buckets' OR violation LIKE '%width'"


@query(f"""
WITH lint AS ({LINT_SQL}), q AS (
  SELECT CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(lower(c_name), '#', '_') END AS product, c_custkey % 4 AS k FROM customer)
SELECT lint.* FROM lint JOIN q USING (product)
WHERE CASE WHEN "table" = '' THEN k <> CASE violation WHEN 'bad version' THEN 0 WHEN 'bad owner email' THEN 1 ELSE 9 END
           ELSE k <> 3 AND NOT (k = 0 AND ({_RULES_SQL})) END
UNION ALL SELECT product, '', 'version', 'bad version' FROM q WHERE k = 0
UNION ALL SELECT product, '', 'owner', 'bad owner email' FROM q WHERE k = 1
UNION ALL SELECT product, '', 'owner', 'no team' FROM q WHERE k = 2
UNION ALL SELECT product, '', 'product', 'no tables' FROM q WHERE k = 3
""")
def gov_lint_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus with NULL fields and arrays; every one is a violation, and hides no other."""
    k = F.col("c_custkey") % 4
    corpus = contract_corpus(load(spark, sf_dir, "customer"), "c_custkey")
    lost = {"version": 0, "email": 1, "team": 2, "tables": 3}
    corpus = corpus.withColumns({c: F.when(k != i, F.col(c)) for c, i in lost.items()})
    without_rules = F.transform("tables", lambda t: t.withField("rules", F.lit(None)).withField("partitions", F.lit(None)))
    corpus = corpus.withColumn("tables", F.when(k == 0, without_rules.cast(f"array<{g.TABLE_STRUCT}>")).otherwise(F.col("tables")))
    return g.lint(corpus)
