from __future__ import annotations

import pytest

from pactlake.contract import parse_product
from pactlake.operators import deployments as d
from pactlake.operators.schema import contract_diff
from pactlake.plans.deploy import current, deploy, read_log, service_levels, teardown, validate
from pactlake.sources.writers import write_table


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "lake"), str(tmp_path / "log")


def test_deploy_validate_redeploy_teardown(spark, paths, document):
    root, log = paths
    document["name"] = "deployed"
    document["tables"][1]["quality_rules"] = [{"not_null": ["day"]}, {"unique": ["day"]}]
    product = parse_product(document)
    assert deploy(spark, product, root, log, "2024-01-01 00:00:00") == "success"
    assert deploy(spark, product, root, log, "2024-01-02 00:00:00") == "skipped"
    assert deploy(spark, product, root, log, "2024-01-03 00:00:00", force=True) == "success"
    assert read_log(spark, log).count() == 2

    rows = spark.sql("SELECT DATE '2024-01-01' AS day, id AS events FROM range(2)")
    write_table(rows, product, "days", root)
    total = validate(spark, product, "2024-01-04").where("tier is null").first()
    # Of the days their uniqueness, freshness and availability fail, of the empty events freshness and availability.
    assert (total.rules, total.failed_rules, total.passed) == (8, 5, False)
    tables = {r.table: (r.rules, r.failed_rules) for r in validate(spark, product, "2024-01-04").where("table is not null").collect()}
    assert tables["raw_events"] == (3, 2)

    listed = d.listing(d.latest(read_log(spark, log))).first()
    assert (listed.product, listed.tables, listed.status) == ("deployed", 2, "success")

    assert teardown(spark, product, log, "2024-01-05 00:00:00") == 2
    assert current(spark, product, log).isEmpty()
    assert deploy(spark, product, root, log, "2024-01-06 00:00:00") == "success"


def test_changed_contract_on_an_existing_table_is_reported(spark, paths, document):
    root, log = paths
    document["name"] = "drifted"
    deploy(spark, parse_product(document), root, log, "2024-01-01 00:00:00")
    document["version"] = "2.0.0"
    days = document["tables"][1]["schema"]
    days[1]["type"] = "double"
    days.append({"name": "visitors", "type": "long"})
    assert deploy(spark, parse_product(document), root, log, "2024-01-02 00:00:00") == "partial"
    row = d.listing(d.latest(read_log(spark, log))).first()
    assert row.version == "2.0.0" and row.status == "partial"
    assert "days.events: type (declared double, found bigint)" in row.errors
    assert "days.visitors: removed" in row.errors


def test_validate_without_rules(spark, product):
    with pytest.raises(ValueError, match="no rules"):
        validate(spark, product, "2024-01-01")


def test_service_levels_come_from_the_contract(spark, document):
    document["sla"] = {"freshness_hours": 2, "min_row_count": 3, "max_row_count": 5, "availability_pct": 50}
    product = parse_product(document)
    rows = spark.sql("SELECT 7 AS event_id, CAST(ts AS timestamp_ntz) AS ts FROM VALUES ('2024-01-01 10:30:00'), ('2024-01-01 01:00:00') AS t(ts)")
    got = {r.promise: (r.measured, r.met) for r in service_levels({"raw_events": rows}, product, "2024-01-01 12:00:00", 12).collect()}
    assert got == {"row_count": (2.0, False), "freshness": (90.0, True), "availability": (33.3333, False)}
    document["enabled"] = False
    assert service_levels({"raw_events": rows}, parse_product(document), "2024-01-01 12:00:00").isEmpty()


def test_contract_diff(spark, document):
    old = parse_product(document)
    events, days = document["tables"]
    events["schema"][0], events["schema"][1] = events["schema"][1], events["schema"][0]
    days["schema"][1]["type"] = "double"
    document["tables"].append({"name": "years", "tier": "gold", "schema": [{"name": "year", "type": "integer"}]})
    got = {(r.table, r.column, r.change) for r in contract_diff(spark, old, parse_product(document)).collect()}
    assert got == {("raw_events", "event_id", "moved"), ("raw_events", "ts", "moved"), ("days", "events", "type"), ("years", "year", "added")}
