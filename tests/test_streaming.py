from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pactlake.contract import Column, Partition, Rule, Table
from pactlake.operators.layout import read_partitioned
from pactlake.operators.quality import BROKEN, run_suite
from pactlake.sources.readers import file_stream
from pactlake.streaming.ingest import deduplicate_stream, ingest_stream
from pactlake.streaming.latest import latest_runs, read_latest, stream_latest
from pactlake.streaming.quality import read_suite, run_suite_stream
from pactlake.streaming.runs import start
from pactlake.streaming.windows import arrivals, count_late, read_arrivals, upsert_arrivals

SCHEMA = "id long, at timestamp_ntz, v long"


class Landing:
    """A folder files arrive in, and a stream over it that takes one file per batch."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp = spark, tmp_path
        self.folder = str(tmp_path / "landing")
        (tmp_path / "landing").mkdir()

    def put(self, *rows):
        df = self.spark.createDataFrame([(i, a, v) for i, a, v in rows], "id long, at string, v long")
        df.withColumn("at", F.col("at").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self, offset=None):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return file_stream(self.spark, self.folder, schema, offset=offset, maxFilesPerTrigger=1)

    def path(self, name):
        return str(self.tmp / name)

    def append(self, stream, name="out"):
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", self.path(name))
        start(writer, self.path(f"{name}_checkpoint"), once=True)
        return self.spark.read.schema(stream.schema).parquet(self.path(name))


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


TABLE = Table(
    "t", "bronze",
    (Column("id", "long", False), Column("at", "timestamp"), Column("v", "integer"), Column("pos", "long")),
    partitions=(Partition("at", "hour"),),
    rules=(Rule("not_null", ("id",)), Rule("max_value", ("v",), {"max": 5}), Rule("unique", ("id",))),
)


def test_ingest_resumes_where_it_stopped(spark, landing):
    run = lambda: ingest_stream(
        landing.stream("pos"), TABLE, landing.path("out"), landing.path("checkpoint"), once=True
    )
    landing.put((1, "2024-01-01 10:00:00", 1), (2, "2024-01-01 11:00:00", 2))
    run()
    run()
    landing.put((3, "2024-01-01 10:30:00", 3))
    run()
    rows = read_partitioned(spark, TABLE, landing.path("out")).collect()
    assert sorted((r.id, r.pos, r["__p_at_hour"]) for r in rows) == [
        (1, 0, "2024-01-01-10"), (2, 1, "2024-01-01-11"), (3, 0, "2024-01-01-10"),
    ]


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_across_batches_are_dropped(landing, salts):
    landing.put(*[(1, "2024-01-01 10:00:00", n) for n in range(50)], (2, "2024-01-01 10:01:00", 0))
    landing.put((1, "2024-01-01 10:05:00", 0), (3, "2024-01-01 10:06:00", 0))
    out = landing.append(deduplicate_stream(landing.stream(), ["id"], "at", "1 hour", salts))
    assert sorted(r.id for r in out.collect()) == [1, 2, 3]


def test_repeats_a_month_apart_are_dropped_for_good(landing):
    landing.put((1, "2024-01-01 10:00:00", 0), (2, "2024-01-01 10:01:00", 0))
    landing.put((3, "2024-02-10 10:00:00", 0))
    landing.put((1, "2024-02-10 10:05:00", 0), (4, "2024-02-10 10:06:00", 0))
    landing.put((4, "2024-06-01 10:06:00", 0), (5, "2024-06-01 10:06:00", 0), (2, "2024-06-02 10:06:00", 0))
    found = {}
    for forever in (True, False):
        out = landing.append(deduplicate_stream(landing.stream(), ["id"], "at", "1 hour", forever=forever), f"out_{forever}")
        found[forever] = sorted(r.id for r in out.collect())
    assert found[True] == [1, 2, 3, 4, 5] and found[False].count(2) == 2


def test_latest_state_over_batches(spark, landing):
    run = lambda: stream_latest(landing.stream(), ["id"], "at", "v", landing.path("log"), landing.path("checkpoint"), once=True)
    read = lambda: {r.id: r.v for r in read_latest(spark, landing.path("log"), ["id"], "at", "v").collect()}
    landing.put((1, "2024-01-01 10:00:00", 1), (1, "2024-01-01 11:00:00", 2), (2, "2024-01-01 10:00:00", 1))
    run()
    landing.put((1, "2024-01-01 10:30:00", 3), (2, "2024-01-01 12:00:00", 4))  # the first is late and loses
    run()
    assert read() == {1: 2, 2: 4}
    landing.put((3, "2024-01-01 09:00:00", 9))
    run()
    assert read() == {1: 2, 2: 4, 3: 9}


def test_runs_are_merged_while_batches_arrive(spark, landing):
    runs = latest_runs(spark, landing.path("log"), ["id"], "at", "v")
    expected, keys = {}, 40
    for batch in range(30):
        rows = [((7 * batch + i) % keys, f"2024-01-01 10:{(13 * batch) % 60:02d}:00", batch) for i in range(10)]
        df = spark.createDataFrame(rows, "id long, at string, v long")
        assert runs.append(df, batch) and not runs.append(df, batch)  # a batch that comes again is not added again
        for i, at, v in rows:
            expected[i] = max(expected.get(i, ("", 0)), (at, v))
        if batch % 3 == 0:
            runs.merge()
            levels = [x.facts["level"] for x in runs.folder.current().layers]
            assert levels.count(0) < 4 and all(levels.count(n) == 1 for n in set(levels) - {0})
    assert runs.rows() <= 3 * keys
    assert {r.id: (r.at, r.v) for r in runs.read().collect()} == expected
    assert len(runs.folder.numbers()) <= 40 and runs.folder.current().marks == {"stream": 29}


def test_two_merges_of_the_same_runs(spark, landing):
    runs = latest_runs(spark, landing.path("log"), ["id"], "at", "v")
    for batch in range(4):
        runs.append(spark.createDataFrame([(batch % 2, "2024-01-01", batch)], "id long, at string, v long"), batch)
    stale, fresh = runs._chosen(runs.folder.current().layers), runs.merge()
    assert fresh == 1 and runs.rows() == 2
    runs._chosen = lambda layers, once=iter([stale, None]): next(once)
    assert runs.merge() == 0 and {r.id: r.v for r in runs.read().collect()} == {0: 2, 1: 3}


def test_merging_goes_on_while_the_stream_runs(spark, landing):
    """A query that is not stopped, with the merger waking up all the time."""
    from pactlake.streaming.runs import start_merged

    runs = latest_runs(spark, landing.path("log"), ["id"], "at", "v")
    for n in range(9):
        landing.put((n % 3, f"2024-01-01 10:{n:02d}:00", n))
    query = start_merged(landing.stream().writeStream.foreachBatch(lambda b, n: runs.append(b, n)), landing.path("checkpoint"), False, [runs], 0.05)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    runs.merge()
    assert {r.id: r.v for r in runs.read().collect()} == {0: 6, 1: 7, 2: 8} and runs.folder.current().marks == {"stream": 8}
    assert sum(x.facts["level"] == 0 for x in runs.folder.current().layers) < 4


def test_all_windows_are_kept_with_the_open_ones(spark, landing):
    landing.put((1, "2024-01-01 10:10:00", 0), (2, "2024-01-01 10:50:00", 0), (3, "2024-01-01 12:05:00", 0))
    run = lambda: upsert_arrivals(arrivals(landing.stream(), "at", "1 hour", "1 hour", 0), landing.path("w"), landing.path("checkpoint"), once=True)
    read = lambda: {str(r.window_start)[11:16]: (r.arrivals, r.closed) for r in read_arrivals(spark, landing.path("w"), 1).collect()}
    run()
    assert read() == {"10:00": (2, True), "12:00": (1, False)}
    landing.put((5, "2024-01-01 12:40:00", 0))
    landing.put((6, "2024-01-01 15:00:00", 0), (4, "2024-01-01 12:50:00", 0))
    run()
    assert read() == {"10:00": (2, True), "12:00": (3, True), "15:00": (1, False)}


def test_the_suite_over_all_batches_equals_the_batch_suite(spark, landing):
    rules = (
        Rule("not_null", ("id", "v")), Rule("max_value", ("v",), {"max": 5}), Rule("unique", ("id", "v")),
        Rule("row_count_between", params={"min": 5, "max": 6}), Rule("freshness_hours", ("at",), {"hours": 24}),
    )
    table = Table("t", "bronze", (Column("id", "long"), Column("at", "timestamp"), Column("v", "long")), rules=rules)
    run = lambda: run_suite_stream(landing.stream(), table, "2024-01-02", landing.path("q"), landing.path("checkpoint"), "p", once=True)
    found = lambda as_of: sorted(map(tuple, read_suite(spark, table, as_of, landing.path("q"), "p").collect()))
    none = spark.createDataFrame([], "id long, at timestamp_ntz, v long")
    assert found("2024-01-02") == sorted(map(tuple, run_suite(none, table, "p", "2024-01-02").collect()))
    landing.put((1, "2024-01-01 10:00:00", 9), (1, "2024-01-01 10:00:00", 1), (None, "2024-01-01 10:00:00", 2))
    landing.put((2, "2024-01-03 10:00:00", None))
    for more in ([], [(1, "2024-01-03 11:00:00", 3), (4, None, 4)], [(4, "2024-01-05 10:00:00", 7)]):
        if more:
            landing.put(*more)
        run()
        run()
        rows = spark.read.schema(none.schema).parquet(landing.folder)
        for as_of in ("2024-01-02", "2024-01-05 12:00:00"):
            assert found(as_of) == sorted(map(tuple, run_suite(rows, table, "p", as_of).collect()))


def test_text_files_have_no_positions(spark, tmp_path):
    with pytest.raises(ValueError, match="no position"):
        file_stream(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, "json", offset="pos")


def test_open_windows_are_withheld_and_late_rows_dropped(landing):
    landing.put((1, "2024-01-01 10:10:00", 0), (2, "2024-01-01 10:50:00", 0), (3, "2024-01-01 13:30:00", 0))
    landing.put((5, "2024-01-01 13:40:00", 0))
    landing.put((4, "2024-01-01 10:20:00", 0))  # its window has been given out
    out = landing.append(arrivals(landing.stream(), "at", "1 hour", "1 hour", 0))
    assert [(str(r.window_start), r.arrivals, r.breached) for r in out.collect()] == [("2024-01-01 10:00:00", 2, True)]


def test_late_rows_are_counted_by_day(spark, landing):
    landing.put((1, "2024-01-01 10:00:00", 60), (2, "2024-01-01 10:00:00", 61), (3, "2024-01-02 10:00:00", 0))
    stream = landing.stream().withColumn("arrived", F.col("at") + F.make_dt_interval(mins=F.col("v").cast("int")))
    count_late(stream, "at", "arrived", 1, landing.path("late"), landing.path("checkpoint"), once=True)
    got = {str(r.day): (r.rows, r.late_rows) for r in spark.read.parquet(landing.path("late")).collect()}
    assert got == {"2024-01-01": (2, 1), "2024-01-02": (1, 0)}


def test_quality_per_batch(spark, landing):
    table = Table("t", "bronze", (Column("id", "long"), Column("at", "timestamp"), Column("v", "long")), rules=TABLE.rules)
    landing.put((1, "2024-01-01 10:00:00", 9), (1, "2024-01-01 10:00:00", 1), (None, "2024-01-01 10:00:00", 1))
    landing.put((1, "2024-01-01 10:00:00", 1))
    run_suite_stream(
        landing.stream(), table, "2024-01-02", landing.path("q"), landing.path("checkpoint"), "p", once=True
    )
    results = spark.read.parquet(landing.path("q") + "/results")
    failed = {(r.batch_id, r.rule_type): r.failed for r in results.collect()}
    sizes = sorted(failed.items())
    assert sum(v for (_, kind), v in sizes if kind == "not_null") == 1
    assert sum(v for (_, kind), v in sizes if kind == "max_value") == 1
    assert sum(v for (_, kind), v in sizes if kind == "unique") == 2  # within a batch only
    rows = spark.read.parquet(landing.path("q") + "/rows")
    assert rows.count() == 4 and rows.where("rejected = 'true'").count() == 3
    assert rows.where(F.array_contains(BROKEN, "unique:id")).count() == 2
