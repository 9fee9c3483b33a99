from __future__ import annotations

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import examine, load_product
from pactlake.functions.expressions import display_name
from pactlake.operators import governance as g
from pactlake.queries.mesh import contract_corpus
from pactlake.queries.registry import CONTRACTS


@pytest.fixture(scope="module")
def corpus(spark):
    return g.contracts_frame(spark, [load_product(p) for p in sorted(CONTRACTS.glob("*.yml"))])


def test_inventory(corpus):
    rows = {(r.table, r.column): r for r in g.column_inventory(corpus).where("product = 'retail_customers'").collect()}
    spend = rows["customer_summary", "total_spend"]
    assert (spend.type, spend.constraint, spend.tier) == ("DECIMAL", "NONE", "gold")
    assert rows["customers", "customer_id"].constraint == "NOT_NULL"


def test_pii(corpus):
    rows = {(r.product, r.table): r for r in g.pii_inventory(corpus).collect()}
    assert rows["retail_customers", "customers"].pii_columns == "full_name"
    assert rows["retail_customers", "customers"].tag == "PII.Sensitive"
    assert rows["retail_orders", "raw_lines"].tag is None


@pytest.mark.parametrize(
    "name", ["raw_customers", "a_b_c", "RAW_x", "raw_2fa_log", "x9y", "_lead", "double__bar", "camelCase"]
)
def test_display_name_is_title_case(spark, name):
    shown = spark.range(1).select(display_name(F.lit(name)).alias("d")).first().d
    assert shown == name.replace("_", " ").title()


def test_default_description(spark, corpus):
    plain = corpus.withColumn(
        "tables", F.transform("tables", lambda t: t.withField("description", F.lit(None).cast("string")))
    )
    row = g.table_labels(plain).where("table = 'order_facts'").first()
    assert row.description == "Gold tier table for retail_orders" and row.display_name == "Order Facts"


def test_owner(spark, corpus):
    teams = spark.createDataFrame([("web", 1), ("web", 1), ("commerce", 2)], "team string, team_id long")
    rows = g.owner_assignment(corpus, teams).collect()
    assert len(rows) == 4 + 3 + 1
    assert {(r.team, r.team_id, r.assigned) for r in rows} == {
        ("web", 1, True), ("commerce", 2, True), ("customer-insight", None, False),
    }


def test_tags(corpus):
    row = g.propagated_tags(corpus).where("column = 'user_id'").first()
    assert row.tags == ["domain:web", "pii", "stream", "tier:critical"]


def test_summary(corpus):
    row = g.product_summary(corpus).where("table = 'raw_customers'").first()
    assert (row.columns, row.rules, row.partitioning, row.pii_columns) == (5, 2, "bucket(customer_id, 8)", "full_name")


def test_coverage(corpus):
    rows = {(r.table, r.column): r for r in g.rule_coverage(corpus).where("product = 'retail_customers'").collect()}
    assert rows["raw_customers", "customer_id"].rules == "not_null,unique"
    assert not rows["raw_customers", "balance"].unguarded  # not required
    assert not any(r.unguarded for r in rows.values())


def test_valid_contracts_have_no_violations(corpus):
    assert g.lint(corpus).isEmpty()


def test_contract_questions_do_not_shuffle(corpus):
    for question in (g.column_inventory, g.pii_inventory, g.table_labels, g.propagated_tags, g.product_summary,
                     g.rule_coverage, g.lint):
        assert "Exchange" not in plan(question(corpus)), question.__name__


def bad_contract(spark, tables, **changes):
    values = {"product": "p", "version": "1.0.0", "team": "t", "email": "a@b.cc", "freshness_hours": 24,
              "availability_pct": 99.0, "tags": [], "tables": tables, **changes}
    return spark.createDataFrame([tuple(values.values())], g.CONTRACTS_SCHEMA)


def column(name, kind="string", nullable=True, precision=None, scale=None):
    return (name, kind, nullable, False, None, [], precision, scale)


def _customers(spark, count):
    return spark.range(0, count, 1, 1).selectExpr(
        "id AS c_custkey", "concat('Customer#', id) AS c_name", "CAST(id % 25 AS int) AS c_nationkey", "1.0D AS c_acctbal", "'FURNITURE' AS c_mktsegment"
    )


def test_contracts_are_built_on_all_cores(spark):
    parts = contract_corpus(_customers(spark, 400)).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 100


@pytest.mark.parametrize("question", [g.lint, g.propagated_tags, g.product_summary, g.rule_coverage, g.lineage_edges, g.declared_tables])
def test_contracts_are_built_once(spark, question):
    filters = [line for line in plan(question(contract_corpus(_customers(spark, 10)))).splitlines() if "Filter" in line.split("(")[0]]
    assert not [line for line in filters if "named_struct" in line or "struct(" in line]


def test_circles_beside_tables_without_any(spark):
    table = lambda name, *inputs: (name, "silver", None, [], list(inputs), [], [], [], [])
    tables = [table("a", "b", "x"), table("b", "c"), table("c", "a"), table("reads", "a"), table("read"), table("a2", "read"), table("own", "own")]
    bad = spark.createDataFrame([("p", "1.0.0", "t", "a@b.co", 1, 1.0, [], tables)], g.CONTRACTS_SCHEMA)
    rows = g.lint(bad).where("violation = 'reads itself in a circle'").collect()
    assert sorted(r.object for r in rows) == ["a", "b", "c", "own"]


def test_lint_finds_everything(spark):
    tables = [
        ("t", "gold", None, [], [], [("x", "week", None, None), ("a", "truncate", None, None)],
         [column("a"), column("a"), column("b-d"), column("n", "number"), column("d", "decimal", precision=1)],
         [("odd", ["a"], []), ("min_value", ["a"], []), ("unique", [], []), ("not_null", ["zz"], [])], None),
        ("t", "gold", None, [], [], [("a", "bucket", None, None)], [], [], []),
    ]
    contract = bad_contract(
        spark, tables, product="Bad-name", version="1.0", email="x", freshness_hours=0, availability_pct=101.0
    )
    got = sorted((r.table, r.object, r.violation) for r in g.lint(contract).collect())
    assert got == sorted([
        ("", "product", "bad product name"), ("", "version", "bad version"), ("", "owner", "bad owner email"),
        ("", "sla", "freshness_hours out of range"), ("", "sla", "availability_pct out of range"),
        ("t", "t", "duplicate table name"), ("t", "a", "duplicate column name"), ("t", "b-d", "bad column name"),
        ("t", "n", "unknown type"), ("t", "d", "decimal without precision and scale"),
        ("t", "x", "unknown transform"), ("t", "x", "partition on unknown column"),
        ("t", "a", "truncate without width"), ("t", "a", "bucket without num_buckets"),
        ("t", "a", "partition on unknown column"), ("t", "t", "no columns"),
        ("t", "odd", "unknown rule"), ("t", "min_value", "rule without its parameter"),
        ("t", "unique", "rule without columns"), ("t", "zz", "rule on unknown column"),
    ])


def test_lint_looks_inside_columns(spark):
    columns = [column(n, k) for n, k in (("s", "struct"), ("a", "array"), ("m", "map"), ("e", "struct"), ("f", "array"))]
    nested = [
        ("s", "x", "decimal", 9, None), ("s", "y-z", "string", None, None), ("s", "in", "struct", None, None),
        ("a", "element", "struct", None, None), ("a.element", "deep", "number", None, None), ("m", "element", "array", None, None),
    ]
    found = g.lint(bad_contract(spark, [("t", "gold", None, [], [], [], columns, [], nested)])).collect()
    assert sorted((r.object, r.violation) for r in found) == [
        ("a.element.deep", "unknown type"), ("e", "struct without fields"), ("f", "no element type"),
        ("m.element", "no element type"), ("s.in", "struct without fields"), ("s.x", "decimal without precision and scale"),
        ("s.y-z", "bad column name"),
    ]


def test_lint_finds_circles(spark):
    def table(name, *inputs):
        return (name, "gold", None, [], list(inputs), [], [column("a")], [], [])

    tables = [table("a", "b"), table("b", "c", "p.b"), table("c", "a"), table("d", "a"), table("e"), table("f", "e", "elsewhere"), table("g", "g"), table("a0", None)]
    found = g.lint(bad_contract(spark, tables)).collect()
    assert sorted((r.table, r.violation) for r in found) == [(n, "reads itself in a circle") for n in "abcg"]


SOUND = {"name": "id", "type": "long"}


def broken(*changes):
    """Paths in the contract document and what to put there; None takes the entry out."""
    return changes


@pytest.mark.parametrize("changes", [
    broken(("name", "1a")), broken(("name", None)), broken(("version", "1")), broken(("owner", None)), broken(("owner", ["x"])), broken(("owner.team", "")),
    broken(("owner.email", "me")), broken(("sla", None)), broken(("sla.freshness_hours", "24")), broken(("sla.freshness_hours", True)),
    broken(("sla.availability_pct", "99")), broken(("sla.availability_pct", 101)), broken(("tables", [])), broken(("tables", {})), broken(("tables", ["t"])),
    broken(("tables.0.tier", "iron")), broken(("tables.0.name", "a-b")), broken(("tables.1.name", "raw_events")), broken(("tables.0.schema", [])),
    broken(("tables.0.schema.1.name", "event_id")), broken(("tables.0.schema.1.name", "a b")), broken(("tables.0.schema.1.type", "text")),
    broken(("tables.0.schema.1.type", None)), broken(("tables.0.schema.1.type", "decimal")), broken(("tables.0.schema.1.type", "struct")),
    broken(("tables.0.schema.1", {"name": "s", "type": "struct", "fields": [{"name": "x y", "type": "long"}]})),
    broken(("tables.0.schema.1", {"name": "s", "type": "struct", "fields": [{"name": "x", "type": "struct"}]})),
    broken(("tables.0.schema.1", {"name": "s", "type": "array", "element_type": "number"})),
    broken(("tables.0.schema.1", {"name": "s", "type": "map", "element_type": "decimal"})),
    broken(("tables.0.schema.1", {"name": "s", "type": "array", "element_type": "array"})),
    broken(("tables.0.schema.1", {"name": "s", "type": "array", "element_type": {"type": "struct", "fields": []}})),
    broken(("tables.0.schema.1", {"name": "s", "type": "array", "element_type": {"type": "array", "element_type": {"type": "decimal"}}})),
    broken(("tables.0.partition_by.0.column", "zz")), broken(("tables.0.partition_by.0.transform", "week")), broken(("tables.0.partition_by.0.transform", "bucket")),
    broken(("tables.0.partition_by.0", {"column": "ts", "transform": "truncate", "width": "4"})), broken(("tables.0.quality_rules", ["unique"])),
    broken(("tables.0.quality_rules", [{"no_rule": ["ts"]}])), broken(("tables.0.quality_rules", [{"unique": ["zz"]}])), broken(("tables.0.quality_rules", [{"regex": ["props"]}])),
    broken(("tables.0.quality_rules", [{"min_value": {"columns": ["value"], "min": None}}])), broken(("tables.0.quality_rules", [{"row_count_between": {}}])),
    broken(("tables.0.quality_rules", [{"freshness_hours": 4}])), broken(("tables.0.inputs", ["days"])), broken(("tables.1.inputs", ["days"])),
])
def test_lint_agrees_with_the_loader(spark, document, changes):
    assert examine(document)[1] == [] and g.lint(g.contracts_frame(spark, [examine(document)[0]])).isEmpty()
    for path, value in changes:
        *way, last = [int(x) if x.isdigit() else x for x in path.split(".")]
        inner = document
        for step in way:
            inner = inner[step]
        if value is None:
            del inner[last]
        else:
            inner[last] = value
    product, problems = examine(document)
    assert problems and not g.lint(g.contracts_frame(spark, [product])).isEmpty()


def test_sound_nested_columns_have_no_violations(spark, document):
    document["tables"][0]["schema"] += [
        {"name": "s", "type": "struct", "fields": [{"name": "x", "type": "decimal", "decimal_precision": 9, "decimal_scale": 2}, {"name": "y", "type": "struct", "fields": [SOUND]}]},
        {"name": "a", "type": "array"}, {"name": "m", "type": "map", "element_type": "long"},
        {"name": "b", "type": "array", "element_type": {"type": "array", "element_type": {"type": "struct", "fields": [SOUND]}}},
    ]
    product, problems = examine(document)
    frame = g.contracts_frame(spark, [product])
    assert problems == [] and g.lint(frame).collect() == []
    paths = {f"{r.x.parent}.{r.x.name}" for r in frame.select(F.explode("tables").alias("t")).select(F.explode("t.nested").alias("x")).collect()}
    assert paths == {"s.x", "s.y", "s.y.id", "a.element", "m.element", "b.element", "b.element.element", "b.element.element.id"}


def test_lint_no_tables(spark):
    assert [r.violation for r in g.lint(bad_contract(spark, [])).collect()] == ["no tables"]


def test_lineage(spark, corpus):
    edges = g.lineage_edges(corpus)
    up = {r.upstream for r in edges.where("table = 'retail_customers.customer_summary'").collect()}
    assert up == {"retail_customers.customers", "retail_customers.raw_orders"}
    missing = {r.upstream for r in g.dangling(edges, g.declared_tables(corpus)).collect()}
    assert missing == {"retail_customers.raw_raw_customers", "retail_customers.raw_raw_orders",
                       "retail_orders.raw_raw_orders", "retail_orders.raw_raw_lines", "site_events.raw_raw_events"}


def test_upstream_with_cycle_and_shortest_distance(spark):
    edges = spark.createDataFrame(
        [("d", "c"), ("c", "b"), ("b", "a"), ("d", "b"), ("a", "c")], "table string, upstream string"
    )
    got = {(r.table, r.upstream): r.distance for r in g.all_upstream(edges).collect()}
    assert got == {
        ("d", "c"): 1, ("d", "b"): 1, ("d", "a"): 2, ("c", "b"): 1, ("c", "a"): 2, ("c", "c"): 3,
        ("b", "a"): 1, ("b", "c"): 2, ("b", "b"): 3, ("a", "c"): 1, ("a", "b"): 2, ("a", "a"): 3,
    }


def test_a_chain_of_a_thousand_tables_takes_ten_rounds(spark, monkeypatch):
    rounds = []
    real = g.materialize
    monkeypatch.setattr(g, "materialize", lambda df, purpose: rounds.append(purpose) or real(df, purpose))
    edges = spark.range(1, 1000).selectExpr("concat('t', id) AS table", "concat('t', id - 1) AS upstream")
    found = g.all_upstream(edges)
    assert found.count() == 999 * 1000 // 2 and found.agg(F.max("distance")).first()[0] == 999
    assert found.where("table = 't700' AND upstream = 't3'").first().distance == 697
    assert len(rounds) <= 12


def test_upstream_equals_a_plain_search(spark):
    import random

    rng = random.Random(5)
    pairs = {(f"t{rng.randrange(40)}", f"t{rng.randrange(40)}") for _ in range(70)}
    edges = spark.createDataFrame(sorted(pairs), "table string, upstream string")
    expected = {}
    for start in {a for a, _ in pairs}:
        level, distance, seen = {start}, 0, {}
        while level:
            distance += 1
            level = {b for a, b in pairs if a in level} - set(seen)
            seen |= {b: distance for b in level}
        expected |= {(start, b): d for b, d in seen.items()}
    assert {(r.table, r.upstream): r.distance for r in g.all_upstream(edges).collect()} == expected
    wanted = spark.createDataFrame([("t1",), ("t7",), ("t7",), ("nowhere",)], "table string")
    found = {(r.table, r.upstream): r.distance for r in g.upstream_of(edges, wanted).collect()}
    assert found == {k: d for k, d in expected.items() if k[0] in ("t1", "t7")}
    assert {r.table: r.steps for r in g.circles(edges).collect()} == {a: d for (a, b), d in expected.items() if a == b}


def test_upstream_moves_rows_of_tables_not_of_pairs(spark, monkeypatch):
    """Each round's table has a row a table, however many pairs there are."""
    written = []
    real = g.materialize
    monkeypatch.setattr(g, "materialize", lambda df, purpose: written.append(real(df, purpose)) or written[-1])
    edges = spark.range(1, 200).selectExpr("concat('t', id) AS table", "concat('t', id - 1) AS upstream")
    found = g.all_upstream(edges)
    assert found.dtypes == [("table", "string"), ("upstream", "string"), ("distance", "int")]
    assert found.count() == 199 * 200 // 2
    assert max(w.count() for w in written) <= 199


@pytest.mark.parametrize("listed", [1, 6, 4096])
def test_upstream_of_tables_with_more_than_a_row_takes(spark, monkeypatch, listed):
    """Ways side by side, a null table and a null upstream, repeated edges, and lists of any length."""
    monkeypatch.setattr(g, "LISTED", listed)
    pairs = [(f"a{i}", f"b{j}") for i in range(4) for j in range(5)] + [(f"b{j}", f"c{k}") for j in range(5) for k in range(3)]
    pairs += [(f"c{k}", "d") for k in range(3)] + [("d", "e"), ("e", "d"), ("a0", "d"), (None, "a0"), (None, "a1"), ("e", None)]
    expected = {}
    for start in {a for a, _ in pairs}:
        level, distance, seen = {start}, 0, {}
        while level:
            distance += 1
            level = {b for a, b in pairs if a in level and (a is not None or distance == 1)} - set(seen)
            seen |= {b: distance for b in level}
        expected |= {(start, b): d for b, d in seen.items()}
    found = g.all_upstream(spark.createDataFrame(pairs + pairs[:7], "table string, upstream string")).collect()
    assert len(found) == len(expected) and {(r.table, r.upstream): r.distance for r in found} == expected


def test_circles_of_a_corpus_without_any(spark, corpus):
    assert g.circles(g.lineage_edges(corpus)).isEmpty()
    assert g.circles(spark.createDataFrame([], "table string, upstream string")).isEmpty()
