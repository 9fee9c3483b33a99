from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactlake.contract import Column, Table
from pactlake.operators.schema import (
    cast_failures, conform, contract_schema, enforce_required, inventory, path_drift, path_inventory, schema_drift,
)

WIDE = Table(
    "wide", "silver",
    (
        Column("s", "string", False, True, "a text", ("x",)), Column("i", "integer"), Column("l", "long"),
        Column("d", "double"), Column("f", "float"), Column("b", "boolean"), Column("t", "timestamp"),
        Column("day", "date"), Column("m", "decimal", precision=9, scale=0), Column("raw", "binary"),
        Column("a", "array", element="long"), Column("kv", "map"),
        Column("st", "struct", fields=(Column("x", "long"), Column("y", "string"))),
    ),
)


def test_every_type():
    kinds = [f.dataType.simpleString() for f in contract_schema(WIDE)]
    assert kinds == [
        "string", "int", "bigint", "double", "float", "boolean", "timestamp_ntz", "date", "decimal(9,0)", "binary",
        "array<bigint>", "map<string,string>", "struct<x:bigint,y:string>",
    ]


def test_schema_keeps_description_and_pii():
    first = contract_schema(WIDE)["s"]
    assert not first.nullable
    assert first.metadata == {"comment": "a text", "pii": True, "tags": ["x"]}


def test_conform_reorders_casts_and_fills(spark):
    raw = spark.createDataFrame([("7", "x", "2024-01-02 03:04:05")], "i string, s string, t string")
    out = conform(raw, WIDE)
    assert out.columns == WIDE.column_names
    row = out.first()
    assert row.s == "x" and row.i == 7 and row.t == dt.datetime(2024, 1, 2, 3, 4, 5) and row.m is None
    assert out.schema["s"].metadata["pii"] is True


def test_conform_bad_value_becomes_null_not_an_error(spark):
    raw = spark.createDataFrame([("x", "not a number"), ("y", None)], "s string, i string")
    assert [r.i for r in conform(raw, WIDE).collect()] == [None, None]


def test_conform_refuses_missing_required(spark):
    with pytest.raises(ValueError, match="required"):
        conform(spark.range(1), WIDE)


def test_cast_failures_do_not_count_nulls(spark):
    raw = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "s string, i string")
    assert {r.column: r.failed for r in cast_failures(raw, WIDE).collect()} == {"s": 0, "i": 1}


def test_enforce_required(spark):
    df = spark.createDataFrame([("a",), (None,)], "s string")
    ok, rejected = enforce_required(df, WIDE)
    assert ok.count() == 1 and rejected.count() == 1


def test_drift(spark):
    old = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType()),
                        T.StructField("c", T.StringType())])
    new = T.StructType([T.StructField("a", T.StringType(), True), T.StructField("b", T.StringType()),
                        T.StructField("d", T.StringType())])
    rows = schema_drift(inventory(spark, "p", "t", old), inventory(spark, "p", "t", new)).collect()
    assert {(r.column, r.change, r.expected, r.actual) for r in rows} == {
        ("a", "type", "bigint", "string"),
        ("a", "nullability", "required", "nullable"),
        ("c", "removed", "string", None),
        ("d", "added", None, "string"),
    }


def test_drift_ignores_unknown_nullability(spark):
    schema = T.StructType([T.StructField("a", T.LongType(), False)])
    known = inventory(spark, "p", "t", schema)
    unknown = known.withColumn("nullable", F.lit(None).cast("boolean"))
    assert schema_drift(known, unknown).isEmpty()


def test_drift_inside_columns(spark):
    old = "id bigint, who struct<name: string, home: struct<city: string, zip: int>>, tags array<string>, marks map<string, struct<n: int>>, gone struct<a: int, b: int>"
    new = "id bigint, who struct<name: string, home: struct<city: string, zip: string>>, tags array<int>, marks map<string, struct<n: int, m: int>>, city struct<x: int>, new struct<a: string>"
    paths = lambda ddl: path_inventory(spark, "p", "t", T.StructType.fromDDL(ddl))
    got = {(r.path, r.change, r.expected, r.actual) for r in path_drift(paths(old), paths(new)).collect()}
    assert got == {
        ("who.home.zip", "type", "int", "string"), ("tags.element", "type", "string", "int"), ("marks.value.m", "added", None, "int"),
        ("gone", "removed", "struct", None), ("city", "added", None, "struct"), ("new", "added", None, "struct"),
    }
    assert path_drift(paths(old), paths(old)).isEmpty()
    moved = "id bigint, who struct<name: string>, home struct<city: string, zip: int>, tags array<string>, marks map<string, struct<n: int>>, gone struct<a: int>"
    got = {(r.path, r.change, r.expected, r.actual) for r in path_drift(paths(old), paths(moved)).collect()}
    assert got == {("who.home", "moved", "who.home", "home"), ("gone.b", "removed", "int", None)}
    retyped = old.replace("struct<name: string, home: struct<city: string, zip: int>>", "string")
    assert [(r.path, r.change) for r in path_drift(paths(old), paths(retyped)).collect()] == [("who", "type")]
