"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as entries
from pactlake.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entries.queries()) and set(ORACLES) <= set(entries.oracle_sql())


def test_entry(spark):
    df = entries.entry(spark)
    assert df.columns == ["product", "table", "tier", "rule_type", "column", "evaluated", "failed", "passed"]
    assert df.count() == 11


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) in (None, "both empty")
