"""Compare registered queries with their SQL: python tests/check.py [sf folder] [query ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, run, sql: str | None) -> tuple[str, int]:
    """The difference as text, empty if there is none, and the number of rows."""
    frame = run(spark, folder)
    ours = [tuple(r) for r in frame.collect()]
    if sql is None:
        return "", len(ours)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}", len(ours)
    a, b = _rows(frame.columns, ours), _rows(names, theirs)
    if a == b:
        return "", len(a)
    odd = next(((x, y) for x, y in zip(a, b) if x != y), None)
    return f"{len(a)} and {len(b)} rows, first difference {odd}", len(a)


def main(arguments: list[str]) -> int:
    from tests.conftest import session

    import __spark_entry__ as contract

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(contract.queries())
    spark, con, bad = session(), connect(folder), 0
    for name in wanted:
        started = time.time()
        try:
            problem, rows = compare(spark, con, folder, contract.queries()[name], contract.oracle_sql().get(name))
        except Exception as failure:
            problem, rows = f"{type(failure).__name__}: {str(failure)[:1500]}", 0
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:24} {rows:8} rows {time.time() - started:6.2f} s {problem[:1800]}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
