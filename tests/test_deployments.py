from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pactlake.operators import deployments as d


def entry(product, version, at, sequence, tables=("t",), errors=(), deleted=False):
    text = json.dumps([{"name": t, "tier": "gold", "resources": ["table"] if t != "t2" else []} for t in tables])
    return (product, version, at, sequence, product, text, json.dumps(list(errors)), deleted)


@pytest.fixture
def log(spark):
    rows = [
        entry("a", "1.0.0", "2024-01-01", 1), entry("a", "1.1.0", "2024-01-02", 2, ("t", "t2")),
        entry("a", "1.0.5", "2024-01-02", 1), entry("b", "1.0.0", "2024-01-01", 1, errors=["x", "y"]),
        entry("c", "1.0.0", "2024-01-01", 1), entry("c", "1.0.0", "2024-01-03", 2, deleted=True),
        entry("e", "1.0.0", "2024-01-01", 1, deleted=True), entry("e", "2.0.0", "2024-01-05", 2),
    ]
    text = d.LOG_SCHEMA.replace("deployed_at timestamp_ntz", "deployed_at string")
    return spark.createDataFrame(rows, text).withColumn("deployed_at", F.col("deployed_at").cast("timestamp_ntz"))


def test_latest(log):
    assert {r.product: r.version for r in d.latest(log).collect()} == {"a": "1.1.0", "b": "1.0.0", "e": "2.0.0"}


def test_get(log):
    assert d.get(log, "a").first().version == "1.1.0"
    assert d.get(log, "c").isEmpty() and d.get(log, "unknown").isEmpty()


def test_listing(log):
    got = {r.product: (r.tables, r.status, r.errors) for r in d.listing(d.latest(log)).collect()}
    assert got == {"a": (2, "success", ""), "b": (1, "partial", "x; y"), "e": (1, "success", "")}


def test_delete_and_deploy_again(spark, log, tmp_path):
    path = str(tmp_path / "log")
    d.append(log, path)
    read = lambda: spark.read.schema(d.LOG_SCHEMA).parquet(path)
    stone = d.tombstones(d.get(read(), "a"), F.lit("2024-02-01").cast("timestamp_ntz"))
    d.append(stone, path)
    assert d.get(read(), "a").isEmpty()
    again = log.where("product = 'a' and version = '1.0.0'").withColumn("deployed_at", F.lit("2024-03-01").cast("timestamp_ntz"))
    d.append(again, path)
    assert d.get(read(), "a").first().version == "1.0.0"


def test_resources(log):
    got = {(r.product, r.table): (r.registered, r.suite) for r in d.resource_matrix(d.latest(log)).collect()}
    assert got[("a", "t")] == (True, False) and got[("a", "t2")] == (False, False)


def test_gate(spark, log):
    requests = spark.createDataFrame(
        [("a", "1.1.0", False), ("a", "1.1.0", True), ("a", "1.2.0", False), ("c", "1.0.0", False), ("z", "1.0.0", False)],
        "product string, version string, force boolean",
    )
    got = {(r.product, r.version, r.force): r.deploy for r in d.redeploy_gate(requests, d.latest(log)).collect()}
    assert got == {
        ("a", "1.1.0", False): False, ("a", "1.1.0", True): True, ("a", "1.2.0", False): True,
        ("c", "1.0.0", False): True, ("z", "1.0.0", False): True,
    }
