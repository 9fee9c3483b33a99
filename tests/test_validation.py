from __future__ import annotations

from dataclasses import replace

import pytest

from pactlake.contract import Column, Partition, Product, Rule, Table
from pactlake.operators.quality import run_suite
from pactlake.plans.validation import run_suite_incremental, unseen_layers
from pactlake.sources.readers import read_table
from pactlake.sources.writers import create_table, drop_product, restore_table, write_table

RULES = (
    Rule("not_null", ("id", "kind")), Rule("max_value", ("id",), {"max": 12}), Rule("unique", ("id", "kind")),
    Rule("row_count_between", params={"min": 3, "max": 9}), Rule("freshness_hours", ("at",), {"hours": 24}),
)


def made(name, *partitions, rules=RULES):
    columns = (Column("id", "long"), Column("kind", "string"), Column("at", "timestamp"))
    return Product(name, "1.0.0", "team", "team@example.com", 24, (Table("rows", "bronze", columns, partitions=partitions, rules=rules),))


def rows(spark, *found):
    df = spark.createDataFrame([(i, k, f"2024-01-{d:02d} 12:00:00") for i, k, d in found], "id long, kind string, at string")
    return df.selectExpr("id", "kind", "CAST(at AS timestamp_ntz) AS at")


@pytest.mark.parametrize("partitions", [(), (Partition("at", "day"),), (Partition("kind"), Partition("id", "bucket", num_buckets=3))])
def test_each_run_reads_what_is_new_and_equals_a_full_run(spark, tmp_path, partitions):
    product, as_of = made(f"changing_{len(partitions)}", *partitions), "2024-01-04 00:00:00"
    same = lambda: (
        sorted(map(tuple, run_suite_incremental(spark, product, "rows", as_of).collect()))
        == sorted(map(tuple, run_suite(read_table(spark, product, "rows"), product.tables[0], product.name, as_of).collect()))
    )
    create_table(spark, product, product.tables[0], str(tmp_path))
    assert same()  # nothing there yet
    writes = [
        ([(1, "a", 1), (2, None, 1), (3, "a", 2)], "append"), ([(3, "b", 3), (13, "c", 3)], "append"),
        ([(7, "a", 2), (None, None, 2)], "overwrite"), ([(8, "x", 3), (9, "x", 3)], "append"), ([(5, "q", 4)], "rebuild"),
    ]
    for n, (found, mode) in enumerate(writes, 1):
        write_table(rows(spark, *found), product, "rows", str(tmp_path), mode=mode)
        assert len(unseen_layers(spark, product, "rows")) == 1
        assert same() and unseen_layers(spark, product, "rows") == []
    restore_table(spark, product, "rows", 2)
    assert unseen_layers(spark, product, "rows") == [] and same()
    drop_product(spark, product)


def test_other_rules_are_counted_anew(spark, tmp_path):
    product = made("ruled")
    write_table(rows(spark, (1, "a", 1), (1, "b", 1)), product, "rows", str(tmp_path))
    run_suite_incremental(spark, product, "rows", "2024-01-02")
    table = replace(product.tables[0], rules=(Rule("unique", ("id",)),))
    other = replace(product, tables=(table,))
    assert len(unseen_layers(spark, other, "rows")) == 1
    found = run_suite_incremental(spark, other, "rows").collect()
    assert [(r.rule_type, r.evaluated, r.failed) for r in found] == [("unique", 2, 2)]
    drop_product(spark, product)
