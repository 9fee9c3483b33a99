"""Every query with SQL against it on the smallest tables; the others by shape."""

from __future__ import annotations

import pytest
from oracle import bag, connect

from pactlake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = bag(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == bag(columns, result.fetchall()) and found


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
