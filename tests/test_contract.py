from __future__ import annotations

import pytest

from pactlake.contract import ContractError, load_product, parse_product
from pactlake.queries.registry import CONTRACTS


def problems(document) -> str:
    with pytest.raises(ContractError) as e:
        parse_product(document)
    return "; ".join(e.value.problems)


def with_rule(document, rule):
    document["tables"][0]["quality_rules"] = [rule]
    return document


def rule_of(document, rule):
    return parse_product(with_rule(document, rule)).tables[0].rules[0]


def with_column(document, **column):
    document["tables"][0]["schema"].append(column)
    return document


def test_derived_names(product):
    assert product.namespace == "site_events"
    assert product.bucket() == "site-events"
    assert product.fqn("days") == "site_events.days"
    assert product.location("/lake/", "days") == "/lake/site_events/silver/days"
    assert product.availability_pct == 99.0 and product.enabled
    assert product.tables[0].required_columns == ["event_id", "ts", "user_id", "event_type"]


def test_defaults(document):
    del document["sla"]["availability_pct"]
    assert parse_product(document).availability_pct == 99.9


@pytest.mark.parametrize("name", ["Weather", "7days", "sky watch", "wetter.heute", "größe", "rain\n", "_rain", ""])
def test_bad_product_names(document, name):
    document["name"] = name
    assert "bad product name" in problems(document)


@pytest.mark.parametrize("version", ["2", "2.1", "2.1.0.4", "2.x.0", "2.1.0\n", ""])
def test_bad_versions(document, version):
    document["version"] = version
    assert "bad version" in problems(document)


@pytest.mark.parametrize("sla", [{"freshness_hours": 0}, {"freshness_hours": 8761}, {}, {"freshness_hours": "24"}])
def test_bad_freshness(document, sla):
    document["sla"] = sla
    assert "freshness_hours" in problems(document)


def test_bad_availability_and_email(document):
    document["sla"]["availability_pct"] = 100.1
    document["owner"]["email"] = "nobody"
    text = problems(document)
    assert "availability_pct" in text and "email" in text  # all problems are reported at once


def test_not_a_mapping():
    assert "mapping" in problems(["a", "list"])


def test_duplicate_tables_and_columns(document):
    document["tables"].append(dict(document["tables"][0]))
    with_column(document, name="ts", type="string")
    text = problems(document)
    assert "duplicate table 'raw_events'" in text and "duplicate column 'ts'" in text


def test_no_tables_or_columns(document):
    document["tables"][0]["schema"] = []
    assert "at least one column" in problems(document)
    document["tables"] = []
    assert "at least one table" in problems(document)


def test_decimal_needs_precision_and_scale(document):
    assert "precision" in problems(with_column(document, name="d", type="decimal"))


def test_decimal_scale_zero_is_kept(document):
    column = with_column(document, name="d", type="decimal", decimal_precision=18, decimal_scale=0)
    assert parse_product(column).tables[0].columns[-1].scale == 0


@pytest.mark.parametrize("column", [{"name": "3rd place", "type": "date"}, {"name": "size", "type": "int128"}, {"type": "long"}])
def test_bad_columns(document, column):
    problems(with_column(document, **column))


def test_struct_needs_fields(document):
    assert "struct needs fields" in problems(with_column(document, name="s", type="struct"))


@pytest.mark.parametrize(
    "rule, kind, columns, params",
    [
        ({"not_null": ["ts", "value"]}, "not_null", ("ts", "value"), {}),
        ({"unique": ["user_id"]}, "unique", ("user_id",), {}),
        ({"unique": "user_id"}, "unique", ("user_id",), {}),
        ({"rule_type": "min_value", "columns": ["value"], "params": {"min": 0}}, "min_value", ("value",), {"min": 0}),
        ({"max_value": {"columns": ["value"], "params": {"max": 1}}}, "max_value", ("value",), {"max": 1}),
        ({"accepted_values": {"columns": ["props"], "values": ["a"]}}, "accepted_values", ("props",), {"values": ["a"]}),
        ({"row_count_between": [1, 5]}, "row_count_between", (), {"min": 1, "max": 5}),
        ({"row_count_between": {"min": 1}}, "row_count_between", (), {"min": 1}),
    ],
)
def test_rule_forms(document, rule, kind, columns, params):
    parsed = rule_of(document, rule)
    assert (parsed.kind, parsed.columns, parsed.params) == (kind, columns, params)


def test_freshness_names_its_column(document):
    rule = rule_of(document, {"freshness_hours": {"column": "ts", "hours": 24}})
    assert rule.columns == ("ts",) and rule.params["hours"] == 24


@pytest.mark.parametrize(
    "rule, text",
    [
        ({"no_such_rule": ["ts"]}, "unknown rule"),
        ({"not_null": ["nope"]}, "unknown column"),
        ({"regex": ["props"]}, "needs 'pattern'"),
        ({"accepted_values": ["props"]}, "needs 'values'"),
        ({"min_value": {"columns": ["value"]}}, "needs 'min'"),
        ({"row_count_between": {}}, "needs 'min' or 'max'"),
        ({"freshness_hours": 24}, "needs a column"),
        ("not_null", "cannot read rule"),
    ],
)
def test_bad_rules(document, rule, text):
    assert text in problems(with_rule(document, rule))


@pytest.mark.parametrize(
    "spec, text",
    [
        ({"column": "user_id", "transform": "bucket"}, "num_buckets"),
        ({"column": "user_id", "transform": "bucket", "num_buckets": 0}, "num_buckets"),
        ({"column": "user_id", "transform": "truncate"}, "width"),
        ({"column": "nope"}, "unknown column"),
        ({"column": "user_id", "transform": "week"}, "unknown transform"),
    ],
)
def test_bad_partitions(document, spec, text):
    document["tables"][0]["partition_by"] = [spec]
    assert text in problems(document)


@pytest.mark.parametrize("hours, days", [(1, 1), (4, 1), (24, 7), (48, 14)])
def test_bronze_retention(document, hours, days):
    document["sla"]["freshness_hours"] = hours
    assert parse_product(document).bronze_retention_days == days


@pytest.mark.parametrize("path", sorted(CONTRACTS.glob("*.yml")), ids=lambda p: p.stem)
def test_shipped_contracts_load(path):
    product = load_product(path)
    assert product.name == path.stem
    tiers = [t.tier for t in product.in_tier_order()]
    assert tiers == sorted(tiers, key=["bronze", "silver", "gold"].index)


@pytest.mark.parametrize("change", [
    {"owner": "me"}, {"sla": 5}, {"tables": "all"}, {"tables": ["one"]}, {"owner": ["a", "b"]},
])
def test_wrong_shapes_are_contract_errors(document, change):
    assert "must be" in problems({**document, **change})


@pytest.mark.parametrize("element", ["decimal", "struct", "nothing"])
def test_element_types(document, element):
    assert "element type" in problems(with_column(document, name="list", type="array", element_type=element))


def test_nested_elements(document):
    from pactlake.operators.schema import contract_schema

    element = {"type": "struct", "fields": [{"name": "a", "type": "decimal", "decimal_precision": 9, "decimal_scale": 2}]}
    table = parse_product(with_column(document, name="list", type="array", element_type=element)).tables[0]
    assert contract_schema(table)["list"].dataType.simpleString() == "array<struct<a:decimal(9,2)>>"


def test_tables_follow_their_inputs(document):
    first = document["tables"][0]
    document["tables"] = [{**first, "name": n, "tier": "gold", "inputs": i} for n, i in (("a", ["b"]), ("b", ["c", "elsewhere"]), ("c", []))]
    assert [t.name for t in parse_product(document).in_tier_order()] == ["c", "b", "a"]
    document["tables"][2]["inputs"] = ["a"]
    assert "circle" in problems(document)


def test_later_tiers_come_later(product):
    assert [(t.name, t.tier, list(t.inputs)) for t in product.in_tier_order()] == [("raw_events", "bronze", []), ("days", "silver", ["raw_events"])]
