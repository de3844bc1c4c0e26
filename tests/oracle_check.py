"""Compare every registered query with its SQL, row by row.

Run as ``python -m tests.oracle_check [sf_dir] [query ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return (type(value).__name__, value.isoformat())
    return (type(value).__name__, value)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """NULL when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    expected = con.sql(sql)
    if sorted(frame.columns) != sorted(expected.columns):
        return f"columns {sorted(frame.columns)} vs {sorted(expected.columns)}"
    ours = _bag(frame.columns, frame.collect())
    theirs = _bag(expected.columns, expected.fetchall())
    if ours == theirs:
        return None
    names = sorted(frame.columns)
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    lines = [f"{sum(ours.values())} rows vs {sum(theirs.values())}; {len(extra)} only here, {len(missing)} only in SQL"]
    for (left, _), (right, _) in zip(sorted(extra, key=repr)[:3], sorted(missing, key=repr)[:3]):
        lines.append(str([(n, a, b) for n, a, b in zip(names, left, right) if a != b][:6]))
    return "\n".join(lines)


def main() -> None:
    import __spark_entry__ as entry
    from feedmill.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        started = time.time()
        problem = compare(spark, con, name, query, oracles[name], sf_dir)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s", problem or "", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
