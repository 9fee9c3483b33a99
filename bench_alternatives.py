"""Each design choice against its alternative, at $BENCH_SF_DIR: median of three warm runs, in seconds."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactlake.contract import Partition, Table
from pactlake.operators.layout import between, read_partitioned, write_partitioned
from pactlake.operators.medallion import latest_state
from pactlake.operators.quality import breaks, checks, mark_broken, run_suite, unique_counts
from pactlake.queries.layout import EVENTS
from pactlake.queries.medallion import summary
from pactlake.queries.quality import ACCOUNTS, LINES, _lines
from pactlake.queries.registry import AS_OF, contract, load
from pactlake.session import build_session, fresh_folder


def timed(make) -> float:
    runs = []
    for _ in range(4):
        begin = time.perf_counter()
        frames = make()
        for df in frames if isinstance(frames, list) else [frames]:
            df.write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - begin)
    return round(statistics.median(runs[1:]), 3)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    read = lambda name: load(spark, sf_dir, name)
    orders_table = contract("retail_orders").table("raw_orders")
    lines = _lines(spark, sf_dir)
    by_day = Table("events", "bronze", EVENTS, partitions=(Partition("ts", "day"),))
    folder = fresh_folder(spark, "alternatives")
    write_partitioned(read("events"), by_day, folder)

    def one_job_per_rule() -> list[DataFrame]:
        single = lambda r, c: Table("orders", "bronze", orders_table.columns, rules=(type(r)(r.kind, (c,) if c else (), r.params),))
        return [run_suite(read("orders"), single(r, c), "p", AS_OF) for r, c in checks(orders_table)]

    def unique_by_window() -> DataFrame:
        return lines.select("line").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("line"))).agg(
            F.sum(F.when(F.col("n") > 1, 1))
        )

    def filter_per_rule() -> list[DataFrame]:
        rules = [(r, c) for r, c in checks(ACCOUNTS) if r.kind != "unique"]
        return [read("customer").where(breaks(r, c, ACCOUNTS)) for r, c in rules]

    def shuffled_summary() -> DataFrame:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        return summary(spark, sf_dir, AS_OF)

    def broadcast_summary() -> DataFrame:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        return summary(spark, sf_dir, AS_OF)

    span = ("2024-01-10 06:00:00", "2024-01-12 18:30:00")
    low, high = [F.lit(v).cast("timestamp_ntz") for v in span]
    plain = Table(ACCOUNTS.name, ACCOUNTS.tier, ACCOUNTS.columns, rules=ACCOUNTS.rules[:-1])
    cases = {
        "suite: shared scan": lambda: run_suite(read("orders"), orders_table, "p", AS_OF),
        "suite: one job per rule": one_job_per_rule,
        "unique: grouped counts": lambda: unique_counts(lines, "line").agg(F.sum(F.when(F.col("__rows") > 1, F.col("__rows")))),
        "unique: window count": unique_by_window,
        "latest: limited row_number": lambda: latest_state(read("events"), ["user_id"], "ts", "event_id"),
        "latest: max_by struct": lambda: read("events").groupBy("user_id").agg(
            F.max_by(F.struct("*"), F.struct("ts", "event_id")).alias("s")).select("s.*"),
        "range: pruned days": lambda: between(read_partitioned(spark, by_day, folder), by_day, "ts", *span),
        "range: whole table": lambda: read_partitioned(spark, by_day, folder).where(F.col("ts").between(low, high)),
        "quarantine: one pass": lambda: mark_broken(read("customer"), plain),
        "quarantine: filter per rule": filter_per_rule,
        "quarantine: repeated keys joined": lambda: mark_broken(lines, LINES),
        "quarantine: repeated keys by window": lambda: lines.withColumn(
            "dup", F.count(F.lit(1)).over(Window.partitionBy("line")) > 1),
        "summary: shuffle joins": shuffled_summary,
        "summary: sized broadcast": broadcast_summary,
    }
    print(json.dumps({name: timed(make) for name, make in cases.items()}, indent=1))


if __name__ == "__main__":
    main()
