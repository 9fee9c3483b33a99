from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from plans import plan
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Product, Table
from pactlake.sources.readers import read_table
from pactlake.sources.versions import Folder, Version, appended, rebuilt, replaced_partitions
from pactlake.sources.writers import create_table, drop_product, expire_versions, restore_table, versions_of, write_table


def made(name, *partitions, **changes):
    columns = (Column("id", "long"), Column("kind", "string"), Column("at", "timestamp"))
    return Product(name, "1.0.0", "team", "team@example.com", 24, (Table("rows", "bronze", columns, partitions=partitions),), **changes)


def rows(spark, begin, end, kind="a"):
    return spark.range(begin, end).select("id", F.lit(kind).alias("kind"), F.expr("TIMESTAMP_NTZ '2024-01-30 00:00:00' + make_dt_interval(id)").alias("at"))


def ids(spark, product, version=None):
    return sorted(r.id for r in read_table(spark, product, "rows", version).collect())


def test_a_failed_rebuild_leaves_the_table(spark, tmp_path):
    product = made("failing", Partition("at", "month"))
    write_table(rows(spark, 0, 6), product, "rows", str(tmp_path))
    broken = rows(spark, 10, 14).withColumn("id", F.expr("IF(id = 13, raise_error('gone'), id)").cast("long"))
    for mode in ("rebuild", "overwrite", "append"):
        with pytest.raises(Exception, match="gone"):
            write_table(broken, product, "rows", str(tmp_path), mode=mode)
        assert ids(spark, product) == list(range(6)) and spark.table("failing.rows").count() == 6
    # What a killed write leaves behind goes, and nothing else.
    folder = product.location(str(tmp_path), "rows")
    versions_of(spark, product, "rows").write(rows(spark, 7, 9), ["at"])
    assert len([n for n in os.listdir(folder) if "=" in n]) == 2 and ids(spark, product) == list(range(6))
    assert expire_versions(spark, product, "rows") == 0
    assert expire_versions(spark, product, "rows", grace_hours=0) == 1 and ids(spark, product) == list(range(6))
    drop_product(spark, product)


@pytest.mark.parametrize("partitions", [(), (Partition("at", "month"),), (Partition("kind", "identity"), Partition("at", "day"))])
def test_modes_and_earlier_versions(spark, tmp_path, partitions):
    product, root = made(f"modes_{len(partitions)}", *partitions), str(tmp_path)
    write_table(rows(spark, 0, 4), product, "rows", root)
    write_table(rows(spark, 4, 6, "b"), product, "rows", root)
    assert ids(spark, product) == [0, 1, 2, 3, 4, 5]
    write_table(rows(spark, 3, 4), product, "rows", root, mode="overwrite")
    now = {0: [3], 1: [0, 1, 3], 2: [0, 1, 2, 3, 4, 5]}[len(partitions)]  # February, or the day of one kind, or all of it
    assert ids(spark, product) == now and sorted(r.id for r in spark.table(product.fqn("rows")).collect()) == now
    write_table(rows(spark, 9, 11).withColumn("kind", F.lit(None).cast("string")), product, "rows", root, mode="rebuild")
    assert ids(spark, product) == [9, 10] and spark.table(product.fqn("rows")).where("kind is null").count() == 2
    assert [ids(spark, product, v) for v in (1, 2, 3)] == [[0, 1, 2, 3], [0, 1, 2, 3, 4, 5], now]
    assert restore_table(spark, product, "rows", 3) == 5 and ids(spark, product) == now
    assert expire_versions(spark, product, "rows", keep=1) >= 1 and ids(spark, product) == now
    with pytest.raises(Exception, match="00000001"):
        read_table(spark, product, "rows", 1)
    drop_product(spark, product)
    create_table(spark, product, product.tables[0], root)
    assert ids(spark, product) == now and spark.table(product.fqn("rows")).count() == len(now)
    drop_product(spark, product)


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    product = made("reading")
    write_table(rows(spark, 0, 3), product, "rows", str(tmp_path))
    before = read_table(spark, product, "rows")
    write_table(rows(spark, 5, 6), product, "rows", str(tmp_path), mode="rebuild")
    assert before.count() == 3 and ids(spark, product) == [5]
    drop_product(spark, product)


def test_only_new_partitions_are_added_to_the_catalog(spark, tmp_path, monkeypatch):
    product = made("cataloged", Partition("at", "day"))
    write_table(rows(spark, 0, 5), product, "rows", str(tmp_path))
    said = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or real(self, text, *a, **k))
    write_table(rows(spark, 5, 7), product, "rows", str(tmp_path))
    altered = [s for s in said if s.startswith("ALTER")]
    assert len(altered) == 1 and altered[0].count("PARTITION (") == 2 and not any("MSCK" in s for s in said)
    monkeypatch.undo()
    assert spark.sql("SHOW PARTITIONS cataloged.rows").count() == 7
    drop_product(spark, product)


def test_partitions_prune_the_scan(spark, tmp_path):
    product = made("pruned", Partition("at", "month"))
    write_table(rows(spark, 0, 6), product, "rows", str(tmp_path))
    write_table(rows(spark, 3, 4), product, "rows", str(tmp_path), mode="overwrite")
    february = read_table(spark, product, "rows").where("__p_at_month = '2024-02'")
    text = plan(february)
    assert "__p_at_month" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [r.id for r in february.collect()] == [3]
    files = {f for r in february.select(F.input_file_name().alias("f")).collect() for f in [r.f]}
    assert len(files) == 1
    drop_product(spark, product)


def test_writers_that_race_all_get_through(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "raced"))
    schema = spark.range(1).schema

    def write(i):
        layer, count = Folder(spark, folder.location).write(spark.range(10 * i, 10 * i + 10))
        assert count == 10
        return Folder(spark, folder.location).commit("append", appended(layer)).number

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(write, range(8)))
    assert sorted(numbers) == list(range(1, 9)) == folder.numbers()
    assert sorted(r.id for r in folder.read(schema).collect()) == list(range(80))
    assert not [n for n in os.listdir(f"{folder.location}/_versions") if n.startswith(".") and not n.endswith(".crc")]


def test_commits(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    assert folder.current() == Version() and folder.read(spark.range(1).schema).isEmpty() and folder.expire() == 0
    layer, _ = folder.write(spark.range(3))
    assert folder.read(spark.range(1).schema).isEmpty()  # written, not committed
    folder.commit("append", lambda now: replace(appended(layer)(now), marks={"stream": 4}))
    assert folder.commit("append", lambda now: None if now.marks["stream"] >= 4 else now).number == 1
    assert folder.current().marks == {"stream": 4} and folder.current().layers[0].facts == {"rows": 3}
    other, _ = folder.write(spark.range(5, 6))
    assert folder.commit("rebuild", rebuilt(other)).number == 2 and folder.read(spark.range(1).schema).first().id == 5


def test_names_of_partitions_are_escaped(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "f"))
    kinds = ["a b", "x/y", "50%", "k=v", "ü", None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "id long, kind string")
    layer, _ = folder.write(df, ["kind"])
    folder.commit("append", appended(layer))
    for i, kind in enumerate(kinds):
        new, _ = folder.write(spark.createDataFrame([(100 + i, kind)], df.schema), ["kind"])
        folder.commit("overwrite", replaced_partitions(new, folder.partitions(new, 1)))
    assert sorted(r.id for r in folder.read(df.schema, ["kind"]).collect()) == list(range(100, 106))


def test_sync_after_a_crash_between_commit_and_catalog(spark, tmp_path):
    product = made("crashed")
    write_table(rows(spark, 0, 2), product, "rows", str(tmp_path))
    folder = versions_of(spark, product, "rows")
    layer, _ = folder.write(rows(spark, 2, 3))
    folder.commit("append", appended(layer))  # and here the writer dies
    assert ids(spark, product) == [0, 1, 2] and spark.table("crashed.rows").count() == 2
    write_table(rows(spark, 7, 8), product, "rows", str(tmp_path))
    assert spark.table("crashed.rows").count() == 4
    drop_product(spark, product)
