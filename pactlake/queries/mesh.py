"""A corpus of contracts derived from the customers, one product each, some of them deliberately broken.

`MESH_SQL` gives the same corpus flat: p = products, t = tables, c = columns, f = what is inside columns,
r = rules (one row per rule column), s = partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.contract import COLUMN_TYPES, TIERS
from pactlake.operators.governance import TABLE_STRUCT

#: Tasks that build contracts, so that the last ones are short.
TASKS_PER_CORE = 4

_TYPES_SQL = "[" + ", ".join(f"'{t}'" for t in COLUMN_TYPES) + "]"

MESH_SQL = f"""
WITH RECURSIVE p AS (
  SELECT c_custkey AS k, c_nationkey AS n, lower(c_mktsegment) AS s,
         CASE WHEN c_acctbal < 0 THEN c_name ELSE replace(lower(c_name), '#', '_') END AS product,
         CASE WHEN c_acctbal > 9500 THEN '1.0' ELSE concat('1.', c_nationkey, '.0') END AS version,
         lower(c_mktsegment) || CASE WHEN c_nationkey = 7 THEN ' at example.com' ELSE '@example.com' END AS email,
         c_nationkey * 400 AS freshness_hours,
         CASE WHEN c_nationkey = 11 THEN 100.5 ELSE 99.9 END AS availability_pct
  FROM customer),
t AS (
  SELECT p.*, i, ['bronze', 'silver', 'gold'][i + 1] AS tier,
         CASE WHEN i = 0 OR (i = 1 AND n = 13) THEN 'raw_' || s WHEN i = 1 THEN s ELSE s || '_summary' END AS tname,
         CASE WHEN i = 0 THEN 'Raw records of ' || s END AS tdesc,
         2 + (n + i) % 4 AS m,
         CASE i WHEN 0 THEN 'nation_' || n || '.feed' WHEN 1 THEN product || '.raw_' || s
                ELSE product || '.' || s END AS input
  FROM p, range(3) x(i)),
c AS (
  SELECT t.*, j, CASE WHEN n = 17 AND j = 2 THEN 'c-2' WHEN n = 19 AND j = 2 THEN 'c1' ELSE 'c' || j END AS cname,
         {_TYPES_SQL}[CAST((k + i + j) % 13 + 1 AS INTEGER)] AS ctype, (k + i + j) % 3 <> 0 AS nullable,
         (k + j) % 7 = 0 AS pii, CASE WHEN j = 1 THEN 'key' END AS cdesc, n <> 3 AS sized
  FROM t, range(1, 6) x(j) WHERE j <= m),
f AS (
  SELECT product, n, i, tname, cname AS parent, CASE WHEN n = 6 THEN 'x-y' ELSE 'x' END AS fname,
         CASE WHEN n = 12 THEN 'varchar' ELSE 'decimal' END AS ftype, n <> 14 AS sized FROM c WHERE ctype = 'struct' AND n <> 4
  UNION ALL SELECT product, n, i, tname, cname, 'element', CASE WHEN n = 16 THEN 'number' ELSE 'array' END, true FROM c
            WHERE ctype IN ('array', 'map') AND n <> 20
  UNION ALL SELECT product, n, i, tname, cname || '.element', 'element', 'string', true FROM c
            WHERE ctype IN ('array', 'map') AND n NOT IN (20, 21)),
r AS (
  SELECT product, n, i, tname, 'not_null' AS kind, 'c1' AS col, true AS complete, 1 AS pos FROM t
  UNION ALL SELECT product, n, i, tname, 'not_null', 'c2', true, 1 FROM t
  UNION ALL SELECT product, n, i, tname, 'unique', 'c1', true, 2 FROM t
  UNION ALL SELECT product, n, i, tname, 'accepted_values', 'c4', n <> 2, 3 FROM t WHERE i = 0
  UNION ALL SELECT product, n, i, tname, 'email_format', 'c3', true, 3 FROM t WHERE i = 1
  UNION ALL SELECT product, n, i, tname, CASE WHEN n = 23 THEN 'no_such_rule' ELSE 'regex' END, 'c2', true, 3
            FROM t WHERE i = 2),
s AS (
  SELECT product, n, i, tname, CASE WHEN i = 2 AND n = 8 THEN 'c9' ELSE 'c1' END AS col,
         CASE WHEN i = 0 THEN CASE WHEN n = 10 THEN 'truncate' ELSE 'day' END WHEN i = 1 THEN 'bucket'
              ELSE CASE WHEN n = 9 THEN 'week' ELSE 'month' END END AS transform,
         CASE WHEN i = 1 THEN CASE WHEN n = 5 THEN 0 ELSE 16 END END AS size
  FROM t)
"""


def contract_corpus(customer: DataFrame, *keep: str) -> DataFrame:
    """One contract per customer: three tables of two to five columns, built within the row.

    A contract is far more work than its customer is bytes, and a file of a million customers may be a single row group that one
    task reads, so the customers are dealt to all cores first.
    """
    tables = ", ".join(_table(i) for i in range(len(TIERS)))
    dealt = customer.repartition(TASKS_PER_CORE * customer.sparkSession.sparkContext.defaultParallelism)
    # The columns of a table are named in it twice.
    columns = {f"columns_{i}": F.expr(_columns(i)) for i in range(len(TIERS))}
    return dealt.withColumn("s", F.lower("c_mktsegment")).withColumns(columns).selectExpr(
        *keep,
        "if(c_acctbal < 0, c_name, replace(lower(c_name), '#', '_')) AS product",
        "if(c_acctbal > 9500, '1.0', concat('1.', c_nationkey, '.0')) AS version",
        "s AS team",
        "concat(s, if(c_nationkey = 7, ' at example.com', '@example.com')) AS email",
        "c_nationkey * 400 AS freshness_hours",
        "if(c_nationkey = 11, 100.5D, 99.9D) AS availability_pct",
        "array(concat('segment:', s), concat('nation:', c_nationkey)) AS tags",
        f"CAST(array({tables}) AS array<{TABLE_STRUCT}>) AS tables",
    )


def _columns(i: int) -> str:
    """SQL of the columns of the i-th table of a customer's contract."""
    types = ", ".join(f"'{t}'" for t in COLUMN_TYPES)
    return f"""transform(sequence(1, 2 + (c_nationkey + {i}) % 4), j -> named_struct(
        'name', CASE WHEN c_nationkey = 17 AND j = 2 THEN 'c-2' WHEN c_nationkey = 19 AND j = 2 THEN 'c1'
                     ELSE concat('c', j) END,
        'type', element_at(array({types}), CAST((c_custkey + {i} + j) % 13 + 1 AS int)),
        'nullable', (c_custkey + {i} + j) % 3 <> 0,
        'pii', (c_custkey + j) % 7 = 0,
        'description', if(j = 1, 'key', NULL),
        'tags', array(concat('pos:', j)),
        'precision', if(c_nationkey <> 3, 18, NULL),
        'scale', if(c_nationkey <> 3, 2, NULL)))"""


def _table(i: int) -> str:
    """SQL of the i-th table of a customer's contract, its columns being in `columns_i`."""
    name = ["concat('raw_', s)", "if(c_nationkey = 13, concat('raw_', s), s)", "concat(s, '_summary')"][i]
    source = ["concat('nation_', c_nationkey, '.feed')", "concat('raw_', s)", "s"][i]
    description = "concat('Raw records of ', s)" if i == 0 else "CAST(NULL AS string)"
    columns = f"columns_{i}"
    last = [
        "named_struct('kind', 'accepted_values', 'columns', array('c4'),"
        " 'params', if(c_nationkey = 2, CAST(array() AS array<string>), array('values')))",
        "named_struct('kind', 'email_format', 'columns', array('c3'), 'params', CAST(array() AS array<string>))",
        "named_struct('kind', if(c_nationkey = 23, 'no_such_rule', 'regex'), 'columns', array('c2'),"
        " 'params', array('pattern'))",
    ][i]
    plain = "'params', CAST(array() AS array<string>)"
    partition = [
        "'column', 'c1', 'transform', if(c_nationkey = 10, 'truncate', 'day'), 'num_buckets', CAST(NULL AS int)",
        "'column', 'c1', 'transform', 'bucket', 'num_buckets', if(c_nationkey = 5, 0, 16)",
        "'column', if(c_nationkey = 8, 'c9', 'c1'), 'transform', if(c_nationkey = 9, 'week', 'month'),"
        " 'num_buckets', CAST(NULL AS int)",
    ][i]
    field = lambda parent, name, kind, digits: (
        f"named_struct('parent', {parent}, 'name', {name}, 'type', {kind}, 'precision', {digits}, 'scale', {digits})"
    )
    nested = f"""flatten(transform({columns}, c -> CASE
        WHEN c.type = 'struct' AND c_nationkey <> 4 THEN array({field("c.name", "if(c_nationkey = 6, 'x-y', 'x')",
            "if(c_nationkey = 12, 'varchar', 'decimal')", "if(c_nationkey <> 14, 18, NULL)")})
        WHEN c.type IN ('array', 'map') AND c_nationkey <> 20 THEN concat(
            array({field("c.name", "'element'", "if(c_nationkey = 16, 'number', 'array')", "0")}),
            if(c_nationkey <> 21, array({field("concat(c.name, '.element')", "'element'", "'string'", "0")}), array()))
        ELSE array() END))"""
    return f"""named_struct(
        'name', {name}, 'tier', '{TIERS[i]}', 'description', {description}, 'tags', array('tier:{TIERS[i]}'),
        'inputs', array({source}),
        'partitions', array(named_struct({partition}, 'width', CAST(NULL AS int))),
        'columns', {columns},
        'rules', array(named_struct('kind', 'not_null', 'columns', array('c1', 'c2'), {plain}),
                       named_struct('kind', 'unique', 'columns', array('c1'), {plain}), {last}),
        'nested', {nested})"""


def nation_contracts(nation: DataFrame) -> DataFrame:
    """The products the customers' bronze tables read from; only the first twenty declare the feed."""
    return nation.selectExpr(
        "concat('nation_', n_nationkey) AS product",
        "'1.0.0' AS version",
        "lower(n_name) AS team",
        "'feeds@example.com' AS email",
        "24 AS freshness_hours",
        "99.9D AS availability_pct",
        "CAST(array() AS array<string>) AS tags",
        f"""CAST(array(named_struct(
            'name', if(n_nationkey < 20, 'feed', 'other'), 'tier', 'bronze', 'description', CAST(NULL AS string),
            'tags', array(), 'inputs', array(), 'partitions', array(), 'columns', array(), 'rules', array(), 'nested', array()
        )) AS array<{TABLE_STRUCT}>) AS tables""",
    )
