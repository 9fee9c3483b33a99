"""Questions over a corpus of contracts, one row per product with nested tables, columns and rules.

A contract is a document of bounded size, so everything about a single contract is answered inside its
row with array functions: no shuffle, and a large corpus is simply more rows. Only owners (G4) and
lineage (G9) relate products to each other; those joins tolerate hot keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pactlake.contract import (
    COLUMN_TYPES, IDENTIFIER_PATTERN, MAX_FRESHNESS_HOURS, PRODUCT_NAME_PATTERN, RULE_KINDS,
    TIERS, TRANSFORMS, VERSION_PATTERN, Product,
)
from pactlake.contract import Column as ContractColumn
from pactlake.functions.expressions import display_name, is_email
from pactlake.functions.skew import skew_join
from pactlake.session import materialize, materialize_counted

COLUMN_STRUCT = (
    "struct<name: string, type: string, nullable: boolean, pii: boolean, description: string,"
    " tags: array<string>, precision: int, scale: int>"
)
RULE_STRUCT = "struct<kind: string, columns: array<string>, params: array<string>>"
PARTITION_STRUCT = "struct<column: string, transform: string, num_buckets: int, width: int>"
#: A field of a struct, or the element of an array or map, at any depth: `parent` is the path of what it is in.
NESTED_STRUCT = "struct<parent: string, name: string, type: string, precision: int, scale: int>"
TABLE_STRUCT = (
    "struct<name: string, tier: string, description: string, tags: array<string>, inputs: array<string>,"
    f" partitions: array<{PARTITION_STRUCT}>, columns: array<{COLUMN_STRUCT}>, rules: array<{RULE_STRUCT}>,"
    f" nested: array<{NESTED_STRUCT}>>"
)
CONTRACTS_SCHEMA = (
    "product string, version string, team string, email string, freshness_hours int, availability_pct double,"
    f" tags array<string>, tables array<{TABLE_STRUCT}>"
)

#: Fixed value: the tag that catalogs know.
PII_TAG = "PII.Sensitive"
UNGUARDED = "unguarded"


def contracts_frame(spark: SparkSession, products: list[Product]) -> DataFrame:
    """Loaded documents as a corpus. Large corpora are read from storage with `CONTRACTS_SCHEMA` instead."""
    rows = []
    for p in products:
        tables = [
            (
                t.name, t.tier, t.description, list(t.tags), list(t.inputs),
                [(s.column, s.transform, _int(s.num_buckets), _int(s.width)) for s in t.partitions],
                [
                    (c.name, c.type, c.nullable, c.pii, c.description, list(c.tags), _int(c.precision), _int(c.scale))
                    for c in t.columns
                ],
                [(str(r.kind), list(r.columns), sorted(k for k, v in r.params.items() if v is not None)) for r in t.rules],
                [x for c in t.columns for x in _nested(c, c.name)],
            )
            for t in p.tables
        ]
        share = float(p.availability_pct) if isinstance(p.availability_pct, (int, float)) else None
        rows.append((p.name, p.version, p.team, p.email, _int(p.freshness_hours), share, list(p.tags), tables))
    return spark.createDataFrame(rows, CONTRACTS_SCHEMA)


def _int(value: object) -> int | None:
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def _nested(column: ContractColumn, path: str) -> list[tuple]:
    """What is inside a column, outermost first."""
    inside = list(column.fields) if column.type == "struct" else []
    if column.type in ("array", "map"):
        element = column.element
        inside = [replace(element, name="element") if isinstance(element, ContractColumn) else ContractColumn("element", element, element=None)]
    out = []
    for c in inside:
        if c.name is not None and c.type is not None or column.element is not None:
            out.append((path, c.name, c.type, _int(c.precision), _int(c.scale)))
            out += _nested(c, f"{path}.{c.name}") if c.element is not None else []
    return out


def contract_tables(contracts: DataFrame, *product_columns: str) -> DataFrame:
    """One row per table, its fields in the struct ``t``.

    For a plain explode Spark adds a filter on the array's size and moves it down to where the array is made, so that
    every contract would be built twice; the outer one has none, and its rows without a table are dropped here.
    """
    tables = contracts.select("product", *product_columns, F.posexplode_outer("tables").alias("at", "t"))
    return tables.where(F.col("at").isNotNull()).drop("at")


def column_inventory(contracts: DataFrame) -> DataFrame:
    """G1: every column with its upper-case type and constraint."""
    columns = contract_tables(contracts).select("product", "t.tier", "t.name", F.explode("t.columns").alias("c"))
    return columns.select(
        "product",
        "tier",
        F.col("name").alias("table"),
        F.col("c.name").alias("column"),
        F.upper("c.type").alias("type"),
        F.when(F.col("c.nullable"), "NONE").otherwise("NOT_NULL").alias("constraint"),
        F.col("c.description").alias("description"),
    )


def pii_inventory(contracts: DataFrame) -> DataFrame:
    """Per table the personal columns, in declared order, and the tag they carry."""
    names = _names(F.filter("t.columns", lambda c: c["pii"]))
    return contract_tables(contracts).select(
        "product",
        F.col("t.name").alias("table"),
        F.size(names).alias("pii_count"),
        F.array_join(names, ",").alias("pii_columns"),
        F.when(F.size(names) > 0, PII_TAG).alias("tag"),
    )


def table_labels(contracts: DataFrame) -> DataFrame:
    """Display name, and a description where the contract gives none."""
    tier = F.col("t.tier")
    default = F.concat(display_name(tier), F.lit(" tier table for "), F.col("product"))
    return contract_tables(contracts).select(
        "product",
        F.col("t.name").alias("table"),
        display_name(F.col("t.name")).alias("display_name"),
        F.coalesce(F.nullif(F.col("t.description"), F.lit("")), default).alias("description"),
    )


def owner_assignment(contracts: DataFrame, teams: DataFrame) -> DataFrame:
    """The owning team's id where the team is known, NULL where not. `teams` is (team, team_id).

    Owners join once per product, before the tables are unfolded; a team owning a third of all products
    is a hot key of that join. A team listed with several ids gets the least.
    """
    lean = contracts.select("product", "team", _names(F.col("tables")).alias("names"))
    owned = skew_join(lean, teams.groupBy("team").agg(F.min("team_id").alias("team_id")), ["team"], "left")
    return owned.select(
        "product", F.explode("names").alias("table"), "team", "team_id", F.col("team_id").isNotNull().alias("assigned")
    )


def propagated_tags(contracts: DataFrame) -> DataFrame:
    """A column carries its product's, table's and own tags, and ``pii`` if personal; sorted."""
    columns = contract_tables(contracts, "tags").select("product", "tags", "t", F.explode("t.columns").alias("c"))
    pii = F.when(F.col("c.pii"), F.array(F.lit("pii"))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    own = [F.coalesce(F.col(c), none) for c in ("tags", "t.tags", "c.tags")]
    tags = F.array_union(F.array_union(own[0], own[1]), F.array_union(own[2], pii))
    return columns.select(
        "product",
        F.col("t.name").alias("table"),
        F.col("c.name").alias("column"),
        F.array_sort(tags).alias("tags"),
    )


def product_summary(contracts: DataFrame) -> DataFrame:
    """The size of each table's contract in one line."""
    text = F.transform(
        "t.partitions",
        lambda p: F.concat(
            p["transform"], F.lit("("), p["column"],
            F.coalesce(F.concat(F.lit(", "), F.coalesce(p["num_buckets"], p["width"]).cast("string")), F.lit("")),
            F.lit(")"),
        ),
    )
    return contract_tables(contracts).select(
        "product",
        F.col("t.tier").alias("tier"),
        F.col("t.name").alias("table"),
        F.size("t.columns").alias("columns"),
        F.array_join(_names(F.filter("t.columns", lambda c: c["pii"])), ",").alias("pii_columns"),
        F.size("t.rules").alias("rules"),
        F.array_join(text, "; ").alias("partitioning"),
    )


def rule_coverage(contracts: DataFrame) -> DataFrame:
    """The rule kinds guarding each column, and whether a required column has none."""
    columns = contract_tables(contracts).select("product", "t", F.explode("t.columns").alias("c"))
    guards = _kinds(F.filter(_listed("t.rules"), lambda r: _holds(F.array_contains(r["columns"], F.col("c.name")))))
    return columns.select(
        "product",
        F.col("t.name").alias("table"),
        F.col("c.name").alias("column"),
        F.array_join(F.array_sort(F.array_distinct(guards)), ",").alias("rules"),
        ((F.size(guards) == 0) & ~F.col("c.nullable")).alias(UNGUARDED),
    )


def lint(contracts: DataFrame) -> DataFrame:
    """One row per violated validity rule, (product, table, object, violation).

    All checks sit in one projection over one scan; nothing is shuffled. A corpus read from storage did not pass the
    loader, so any field may be NULL: a missing array counts as empty and a missing value breaks its rule. What the loader
    rejects has a violation, and what it takes has none.
    """
    product_level = _found(
        "",
        [
            (~_holds(F.col("product").rlike(_whole(PRODUCT_NAME_PATTERN))), "product", "bad product name"),
            (~_holds(F.col("version").rlike(_whole(VERSION_PATTERN))), "version", "bad version"),
            (~_holds(is_email(F.col("email"))), "owner", "bad owner email"),
            (~_holds(F.col("freshness_hours").between(1, MAX_FRESHNESS_HOURS)), "sla", "freshness_hours out of range"),
            (~_holds(F.col("availability_pct").between(0.0, 100.0)), "sla", "availability_pct out of range"),
            (~_holds(F.trim("team") != ""), "owner", "no team"),
            (F.size(_listed("tables")) == 0, "product", "no tables"),
        ],
    )
    tables = _listed("tables")
    duplicate_tables = F.transform(_repeated(_names(tables)), lambda n: _violation(n, n, "duplicate table name"))
    circular = F.transform(_circular(tables), lambda n: _violation(n, n, "reads itself in a circle"))
    # The column names of a table are looked up for every rule, so they are put beside it once.
    named = F.transform(tables, lambda t: F.struct(t.alias("t"), _names(_listed(t["columns"])).alias("names")))
    per_table = F.flatten(F.transform(named, lambda x: _table_violations(x["t"], x["names"])))
    # Not `inline`, for the reason given in `contract_tables`: its filter would find all violations a second time.
    found = contracts.select("product", F.inline_outer(F.concat(product_level, duplicate_tables, circular, per_table)))
    return found.where(F.col("violation").isNotNull())


def _circular(tables: Column) -> Column:
    """The tables of a contract that come before and after one another: what is left when tables without open inputs, and
    then tables that none of those left reads, are taken away until nothing changes."""
    pairs = F.flatten(
        F.transform(tables, lambda t: F.transform(_listed(t["inputs"]), lambda i: F.struct(t["name"].alias("name"), i.alias("input"))))
    )

    def peeled(inner: Column, left: Column, mine: str, other: str) -> Column:
        open_ = lambda now: F.transform(F.filter(inner, lambda x: F.array_contains(now, x[other])), lambda x: x[mine])
        return F.aggregate(left, left, lambda now, _: F.array_intersect(now, open_(now)))

    def left_over(names: Column, inner: Column) -> Column:
        outputs = _once(peeled(inner, names, "name", "input"), lambda left: peeled(inner, left, "input", "name"))
        return F.when(F.size(inner) > 0, outputs).otherwise(F.array().cast("array<string>"))

    within = lambda names: F.filter(pairs, lambda x: _holds(F.array_contains(names, x["input"])))
    return _once(F.array_distinct(_names(tables)), lambda names: _once(within(names), lambda inner: left_over(names, inner)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that it needs several times and that is found once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _table_violations(t: Column, names: Column) -> Column:
    columns, nested, rules, partitions = (_listed(t[f]) for f in ("columns", "nested", "rules", "partitions"))
    unknown = lambda c: ~_holds(F.array_contains(names, c))
    flag = lambda items, broken, name, text: F.transform(
        F.filter(items, broken), lambda i: _violation(t["name"], name(i), text)
    )
    by_name = lambda i: i["name"]
    by_kind = lambda i: i["kind"]
    by_column = lambda i: i["column"]
    needs = {"regex": "pattern", "accepted_values": "values", "min_value": "min", "max_value": "max",
             "freshness_hours": "hours"}
    has = lambda r, param: _holds(F.array_contains(r["params"], param))
    path = lambda x: F.concat_ws(".", x["parent"], x["name"])
    # What must have something inside, with its path.
    outer = F.concat(
        F.transform(columns, lambda c: F.struct(c["name"].alias("path"), c["type"].alias("type"))),
        F.transform(nested, lambda x: F.struct(path(x).alias("path"), x["type"].alias("type"))),
    )
    hollow = F.filter(
        F.filter(outer, lambda x: x["type"].isin("struct", "array", "map")), lambda x: ~F.exists(nested, lambda y: _holds(y["parent"] == x["path"]))
    )
    missing_param = lambda r: _any(
        [(r["kind"] == kind) & ~has(r, param) for kind, param in needs.items()]
        + [(r["kind"] == "row_count_between") & ~has(r, "min") & ~has(r, "max")]
    )
    rule_targets = F.flatten(
        F.transform(rules, lambda r: F.transform(F.filter(_listed(r["columns"]), unknown), lambda c: F.struct(
            r["kind"].alias("kind"), c.alias("column"))))
    )
    return F.concat(
        _found(t["name"], [
            (~_holds(t["name"].rlike(_whole(IDENTIFIER_PATTERN))), t["name"], "bad table name"),
            (~_holds(t["tier"].isin(*TIERS)), t["name"], "unknown tier"),
            (F.size(columns) == 0, t["name"], "no columns"),
        ]),
        F.transform(_repeated(names), lambda n: _violation(t["name"], n, "duplicate column name")),
        flag(columns, lambda c: ~_holds(c["name"].rlike(_whole(IDENTIFIER_PATTERN))), by_name, "bad column name"),
        flag(columns, lambda c: ~_holds(c["type"].isin(*COLUMN_TYPES)), by_name, "unknown type"),
        flag(
            columns,
            lambda c: (c["type"] == "decimal") & (c["precision"].isNull() | c["scale"].isNull()),
            by_name, "decimal without precision and scale",
        ),
        F.transform(hollow, lambda x: _violation(
            t["name"], x["path"], F.when(x["type"] == "struct", "struct without fields").otherwise("no element type"))),
        flag(nested, lambda x: ~_holds(x["name"].rlike(_whole(IDENTIFIER_PATTERN))), path, "bad column name"),
        flag(nested, lambda x: ~_holds(x["type"].isin(*COLUMN_TYPES)), path, "unknown type"),
        flag(
            nested,
            lambda x: (x["type"] == "decimal") & (x["precision"].isNull() | x["scale"].isNull()),
            path, "decimal without precision and scale",
        ),
        flag(partitions, lambda p: ~_holds(p["transform"].isin(*TRANSFORMS)), by_column, "unknown transform"),
        flag(
            partitions,
            lambda p: (p["transform"] == "bucket") & ~F.coalesce(p["num_buckets"] > 0, F.lit(False)),
            by_column, "bucket without num_buckets",
        ),
        flag(
            partitions,
            lambda p: (p["transform"] == "truncate") & ~F.coalesce(p["width"] > 0, F.lit(False)),
            by_column, "truncate without width",
        ),
        flag(partitions, lambda p: unknown(p["column"]), by_column, "partition on unknown column"),
        flag(rules, lambda r: ~_holds(r["kind"].isin(*RULE_KINDS)), by_kind, "unknown rule"),
        flag(rules, missing_param, by_kind, "rule without its parameter"),
        flag(
            rules,
            lambda r: r["kind"].isin(*RULE_KINDS) & (r["kind"] != "row_count_between") & (F.size(_listed(r["columns"])) == 0),
            by_kind, "rule without columns",
        ),
        F.transform(rule_targets, lambda x: _violation(t["name"], x["column"], "rule on unknown column")),
    )


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _listed(value: Column | str) -> Column:
    """An array, empty where there is none."""
    return F.coalesce(value, F.array())


def _violation(table: Column, item: Column, text: Column | str) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.struct(table.alias("table"), item.alias("object"), text.alias("violation"))


def _found(table: Column | str, tests: list[tuple[Column, Column | str, str]]) -> Column:
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.array_compact(
        F.array(*[F.when(bad, _violation(as_column(table), as_column(item), text)) for bad, item, text in tests])
    )


def _names(structs: Column) -> Column:
    return F.transform(structs, lambda s: s["name"])


def _kinds(structs: Column) -> Column:
    return F.transform(structs, lambda s: s["kind"])


def _repeated(names: Column) -> Column:
    """The values that occur more than once, each once."""
    times = lambda n: F.size(F.filter(names, lambda other: other == n))
    return F.filter(F.array_distinct(names), lambda n: times(n) > 1)


def _any(conditions) -> Column:
    result = F.lit(False)
    for c in conditions:
        result = result | c
    return result


def _whole(pattern: str) -> str:
    """In Java ``$`` also matches before a closing newline."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def lineage_edges(contracts: DataFrame) -> DataFrame:
    """(table, upstream) pairs as ``product.table``.

    Declared inputs; a table that declares none reads the table of its name with the prefix of the tier
    below (``raw_`` for bronze). An input with a dot names another product's table.
    """
    tier = F.col("t.tier")
    prefix = F.when(tier == "bronze", "raw_").when(tier == "silver", "bronze_").otherwise("silver_")
    fallback = F.array(F.concat(prefix, F.col("t.name")))
    inputs = F.when(F.size("t.inputs") > 0, F.col("t.inputs")).otherwise(fallback)
    edges = contract_tables(contracts).select("product", F.col("t.name").alias("name"), F.explode(inputs).alias("i"))
    full = F.when(F.contains("i", F.lit(".")), F.col("i")).otherwise(F.concat_ws(".", "product", "i"))
    return edges.select(F.concat_ws(".", "product", "name").alias("table"), full.alias("upstream")).distinct()


def declared_tables(contracts: DataFrame) -> DataFrame:
    return contract_tables(contracts).select(F.concat_ws(".", "product", "t.name").alias("table")).distinct()


def dangling(edges: DataFrame, tables: DataFrame) -> DataFrame:
    """Edges whose upstream no contract declares. A popular upstream is a hot key."""
    return skew_join(edges, tables.select(F.col("table").alias("upstream")), ["upstream"], "left_anti").select(
        "table", "upstream"
    )


#: Upstream tables that are kept and compared in one row. What a table has found beyond that takes a row each.
LISTED = 4096


def all_upstream(edges: DataFrame) -> DataFrame:
    """Every (table, upstream, distance), distance the shortest way.

    Found ways double in length each round: once all ways of up to n steps are known, those of n + 1 to 2n steps are a
    way of exactly n steps and a known one. So a chain of a thousand tables takes ten rounds, every way is made of two
    that are shortest, and a circle ends because its ways get no shorter. Each round is written out, which is what a lost executor costs.

    What a table has found is two lists in its row, so that a round moves and sorts rows of tables, not of pairs. A table
    that could be given more than `LISTED` is counted out beforehand, from the lengths of the lists alone, and its pairs are
    compared as rows, in each round that this holds for it.
    """
    pairs = edges.select("table", "upstream").distinct()
    first = pairs.select("table", F.array("upstream").alias("upstreams"), F.array(F.lit(1)).alias("distances"))
    found, most, widest = _written(first, 1)
    reach, split = 1, True
    while True:
        longest = found.select("table", F.explode("last").alias("via"))
        further = F.transform("distances", lambda d: d + reach).alias("distances")
        onward = found.select(F.col("table").alias("via"), "upstreams", further)
        ways = skew_join(longest, onward, ["via"], "inner", LISTED).select("table", "upstreams", "distances")
        ways = found.select(*ways.columns).unionByName(ways)
        many, long = _many(found, longest) if split or most * (1 + widest) > LISTED else (None, 0)
        same = F.col("table").eqNullSafe(F.col("long"))
        few = ways.join(many, same, "left_anti") if long else ways
        both = _shortest(few.groupBy("table").agg(F.collect_list(F.struct("upstreams", "distances")).alias("lists")))
        if long:
            single = ways.join(many, same, "left_semi").select("table", F.inline(_zipped()))
            single = single.groupBy("table", "upstream").agg(F.min("distance").alias("distance"))
            both = both.unionByName(single.select("table", F.array("upstream").alias("upstreams"), F.array("distance").alias("distances")))
        reach, split = 2 * reach, long > 0
        found, most, widest = _written(both, reach)
        if not widest:
            return found.select("table", F.inline(_zipped()))


def _written(ways: DataFrame, reach: int) -> tuple[DataFrame, int, int]:
    """The ways with how many they are and the tables that are `reach` steps away; the most of both in a row."""
    last = F.filter("upstreams", lambda _, i: F.get("distances", i) == reach)
    observed = Observation()
    rows = ways.withColumns({"size": F.size("upstreams"), "last": last})
    rows = rows.observe(observed, F.max("size").alias("most"), F.max(F.size("last")).alias("widest"))
    return materialize(rows, "lineage"), observed.get["most"] or 0, observed.get["widest"] or 0


def _many(found: DataFrame, longest: DataFrame) -> tuple[DataFrame, int]:
    """The tables that would be given more than `LISTED` ways, those they have included, and their number."""
    sizes = found.groupBy(F.col("table").alias("via")).agg(F.sum("size").alias("size"))
    given = found.select("table", "size").unionByName(skew_join(longest, sizes, ["via"], "inner").select("table", "size"))
    sums = given.groupBy(F.col("table").alias("long")).agg(F.sum("size").alias("size"))
    return materialize_counted(sums.where(F.col("size") > LISTED).select("long"), "lineage")


def _zipped() -> Column:
    return F.arrays_zip(F.col("upstreams").alias("upstream"), F.col("distances").alias("distance"))


def _shortest(rows: DataFrame) -> DataFrame:
    """Lists joined, with the shortest way to each upstream; put in order only if one is there more than once."""
    rows = rows.select("table", *[F.flatten(F.col(f"lists.{c}")).alias(c) for c in ("upstreams", "distances")])
    again = F.size(F.array_distinct("upstreams")) < F.size("upstreams")
    rows = rows.withColumn("ordered", F.when(again, F.sort_array(_zipped())))
    least = F.filter("ordered", lambda w, i: (i == 0) | ~w["upstream"].eqNullSafe(F.get("ordered", i - 1)["upstream"]))
    rows = rows.withColumn("least", least)
    return rows.select(
        "table", F.coalesce(F.col("least.upstream"), "upstreams").alias("upstreams"), F.coalesce(F.col("least.distance"), "distances").alias("distances")
    )


def upstream_of(edges: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, upstream, distance) for the given tables only. Walks up from them a level a round and follows no
    edge that they do not need, so a few tables of a large corpus cost a few joins with what they read."""
    edges = materialize(edges.select("table", "upstream").distinct(), "edges")
    onward = edges.select(F.col("table").alias("via"), F.col("upstream").alias("next"))
    found = frontier = materialize(
        edges.join(tables.select("table").distinct(), "table", "left_semi").withColumn("distance", F.lit(1)), "walk"
    )
    while True:
        step = skew_join(frontier.withColumnRenamed("upstream", "via"), onward, ["via"], "inner")
        step = step.select("table", F.col("next").alias("upstream"), (F.col("distance") + 1).alias("distance")).distinct()
        frontier, pairs = materialize_counted(step.join(found.select("table", "upstream"), ["table", "upstream"], "left_anti"), "walk")
        if pairs == 0:
            return found
        found = found.unionByName(frontier)


def circles(edges: DataFrame) -> DataFrame:
    """The tables of all products that depend on themselves.

    Edges into tables without inputs, and edges out of tables that nobody reads, are taken away round by round until none is
    left to take; what remains, usually nothing, are circles and the ways between them, and a table is in a circle if
    it reaches itself there.
    """
    left, count = materialize_counted(edges.select("table", "upstream").distinct(), "peeled")
    while count:
        into = left.join(left.select(F.col("table").alias("upstream")).distinct(), "upstream", "left_semi")
        both = into.join(into.select(F.col("upstream").alias("table")).distinct(), "table", "left_semi")
        left, after = materialize_counted(both.select("table", "upstream"), "peeled")
        if after == count:
            break
        count = after
    return all_upstream(left).where(F.col("table") == F.col("upstream")).select("table", F.col("distance").alias("steps"))
