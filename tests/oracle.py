"""Run a registered query and its SQL on the same files and compare the rows.

    python tests/oracle.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, int):
        return ("int", value)
    return (type(value).__name__, value)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when equal, otherwise what differs."""
    from pactlake.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = bag(df.columns, (tuple(r) for r in df.collect()))
    if name not in ORACLES:
        return None
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = bag(columns, result.fetchall())
    if got == want:
        return None if got else "both empty"
    only_got, only_want = got - want, want - got
    return (
        f"{sum(got.values())} rows vs {sum(want.values())}; only spark {list(only_got.items())[:2]};"
        f" only sql {list(only_want.items())[:2]}"
    )


def main() -> int:
    from pactlake.queries import QUERIES
    from pactlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - begin:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
