from __future__ import annotations

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import Column, Rule, Table, parse_product
from pactlake.operators.quality import BROKEN
from pactlake.operators.schema import conform
from pactlake.sources.readers import ingest, read_table
from pactlake.sources.writers import (
    create_table, drop_product, ensure_namespace, read_quarantine, write_quarantine, write_table,
)

TABLE = Table("t", "bronze", (Column("id", "long", False), Column("n", "integer"), Column("missing", "string")))


def test_csv_is_cast_not_inferred(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("n,id\n1,10\nx,11\n")
    got = {r.id: (r.n, r.missing) for r in ingest(spark, str(path), TABLE, "csv").collect()}
    assert got == {10: (1, None), 11: (None, None)}


def test_json(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"id": 1, "n": 2, "other": 3}\n{"id": "2", "n": "x"}\n')
    got = {r.id: r.n for r in ingest(spark, str(path), TABLE, "json").collect()}
    assert got == {1: 2, 2: None}


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).selectExpr("id", "CAST(id AS int) n", "id unused").write.parquet(path)
    text = plan(ingest(spark, path, TABLE, where="id > 3"))
    assert "GreaterThan(id,3)" in text and "unused" not in text.split("ReadSchema")[1]


def partitioned(document, name):
    document["name"] = name
    document["tables"][0]["partition_by"] = [{"column": "ts", "transform": "month"}]
    return parse_product(document)


def some_rows(spark, n):
    return spark.range(n).selectExpr(
        "id AS event_id", "7 AS user_id", "'view' AS event_type", "1.0D AS value", "TIMESTAMP_NTZ '2024-01-31 12:00:00' + make_dt_interval(id) AS ts"
    )


def test_table_lifecycle(spark, tmp_path, document):
    product = partitioned(document, "lifecycle")
    root = str(tmp_path)
    assert write_table(some_rows(spark, 3), product, "raw_events", root) == 3
    ensure_namespace(spark, product)
    create_table(spark, product, product.table("raw_events"), root)  # both leave what is there
    assert write_table(some_rows(spark, 1), product, "raw_events", root) == 1
    assert read_table(spark, product, "raw_events").count() == 4

    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES lifecycle.raw_events").collect()}
    assert properties["tier"] == "bronze" and properties["product_owner"] == "web" and properties["pii_columns"] == "user_id"
    shown = {r.info_name: r.info_value for r in spark.sql("DESCRIBE NAMESPACE EXTENDED lifecycle").collect()}
    assert "web@example.com" in shown["Properties"]

    assert drop_product(spark, product) == 1
    assert drop_product(spark, product) == 0
    create_table(spark, product, product.table("raw_events"), root)
    assert read_table(spark, product, "raw_events").count() == 4
    drop_product(spark, product)


def test_overwrite_is_by_partition_and_leaves_the_session_alone(spark, tmp_path, document):
    product = partitioned(document, "overwritten")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        write_table(some_rows(spark, 4), product, "raw_events", str(tmp_path))  # 1 in January, 3 in February
        write_table(some_rows(spark, 1), product, "raw_events", str(tmp_path), mode="overwrite")
        write_table(some_rows(spark, 1), product, "raw_events", str(tmp_path), mode="overwrite")
        assert spark.conf.get(mode) == "static"
    finally:
        spark.conf.set(mode, before)
    assert read_table(spark, product, "raw_events").count() == 4


def test_bad_values_become_null_and_are_stored(spark, tmp_path, document):
    product = partitioned(document, "bad_values")
    raw = spark.createDataFrame([("1", "2", "view", "x", "2024-01-01")], "event_id string, user_id string, event_type string, value string, ts string")
    write_table(raw, product, "raw_events", str(tmp_path))
    assert read_table(spark, product, "raw_events").first().value is None


def test_comments_with_quotes(spark, tmp_path, document):
    document["name"] = "quoted"
    document["tables"][0]["description"] = "it's a \\ table"
    product = parse_product(document)
    create_table(spark, product, product.table("raw_events"), str(tmp_path))
    assert spark.catalog.getTable("quoted.raw_events").description == "it's a \\ table"


def test_stored_quarantine_reads_one_side_only(spark, tmp_path):
    table = Table("t", "silver", (Column("id", "long"),), rules=(Rule("min_value", ("id",), {"min": 5}),))
    path = str(tmp_path / "q")
    write_quarantine(spark.range(10), table, path)
    bad = read_quarantine(spark, path, True)
    assert bad.count() == 5 and {tuple(r[BROKEN]) for r in bad.collect()} == {("min_value:id",)}
    assert "PartitionFilters: [isnotnull(rejected" in plan(bad)
    assert read_quarantine(spark, path, False).agg(F.min("id")).first()[0] == 5


def test_columns_go_by_name_whatever_their_order(spark, tmp_path, document):
    product = partitioned(document, "reordered")
    write_table(some_rows(spark, 1), product, "raw_events", str(tmp_path))
    document["tables"][0]["schema"].reverse()
    later = parse_product(document)
    write_table(some_rows(spark, 1).withColumn("event_id", F.lit("7")), later, "raw_events", str(tmp_path))
    assert {(r.event_id, r.value) for r in read_table(spark, later, "raw_events").collect()} == {(0, 1.0), (7, 1.0)}
    drop_product(spark, product)


def test_rebuild_leaves_no_old_row(spark, tmp_path, document):
    product = partitioned(document, "rebuilt")
    write_table(some_rows(spark, 4), product, "raw_events", str(tmp_path))
    write_table(some_rows(spark, 1), product, "raw_events", str(tmp_path), mode="rebuild")
    assert read_table(spark, product, "raw_events").count() == 1
    assert spark.sql("SHOW PARTITIONS rebuilt.raw_events").count() == 1
    drop_product(spark, product)


def test_clean_second_run_leaves_no_rejects(spark, tmp_path):
    table = Table("t", "silver", (Column("id", "long"),), rules=(Rule("min_value", ("id",), {"min": 5}),))
    path = str(tmp_path / "q")
    write_quarantine(spark.range(10), table, path)
    write_quarantine(spark.range(5, 10), table, path)
    assert read_quarantine(spark, path, True).isEmpty()


def test_foreign_tables_keep_the_namespace(spark, tmp_path, document):
    product = partitioned(document, "shared_space")
    write_table(some_rows(spark, 1), product, "raw_events", str(tmp_path))
    spark.sql("CREATE TABLE shared_space.other (a int) USING parquet")
    assert drop_product(spark, product) == 1 and spark.catalog.tableExists("shared_space.other")
    spark.sql("DROP TABLE shared_space.other")
    assert drop_product(spark, product) == 0 and not spark.catalog.databaseExists("shared_space")


def test_letter_case_of_source_columns(spark):
    rows = spark.createDataFrame([(1, "x")], "ID long, N string")
    assert conform(rows, TABLE).first() == (1, None, None)
    with pytest.raises(ValueError, match="letter case"):
        conform(spark.createDataFrame([(1, 2)], "id long, ID long"), TABLE)


def test_json_under_other_names(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"key": 1, "size": 2}\n{"key": 2, "size": 9}\n')
    got = ingest(spark, str(path), TABLE, "json", where="size > 5", rename={"id": "key", "n": "size"}, schema="key long, size int")
    assert [(r.id, r.n) for r in got.collect()] == [(2, 9)]


def test_blank_partition_values_are_refused(spark, tmp_path, document):
    document["name"] = "blanks"
    document["tables"][0]["partition_by"] = [{"column": "event_type"}]
    product = parse_product(document)
    with pytest.raises(Exception, match="empty text"):
        write_table(some_rows(spark, 1).withColumn("event_type", F.lit("")), product, "raw_events", str(tmp_path))
    drop_product(spark, product)
