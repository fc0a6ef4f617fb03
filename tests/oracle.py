"""Compare every named query with its SQL twin in DuckDB: columns, types, row values.

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_plain(r[i]) for i in order) for r in rows]


def compare(con, df, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    got_columns = df.columns
    got = _rows(got_columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = _rows(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    if not got:
        return "no rows on either side"
    for i, name in enumerate(sorted(got_columns)):
        kinds = [{_kind(r[i]) for r in rows if r[i] is not None} for rows in (got, want)]
        if kinds[0] != kinds[1]:
            return f"types of {name}: {kinds[0]} != {kinds[1]}"
    extra, missing = Counter(got) - Counter(want), Counter(want) - Counter(got)
    if extra:
        return f"{sum(extra.values())} rows differ: {list(extra)[:3]} != {list(missing)[:3]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from tablewright.catalog import ORACLES, QUERIES
    from tablewright.session import get_session

    spark = get_session("tablewright oracle", cores=8)
    con = connect(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = compare(con, df, ORACLES[name])
                result = "same" if problem is None else f"DIFFERENT {problem}"
            else:
                problem = None if (n := len(df.collect())) else "no rows"
                result = f"{n} rows"
        except Exception as error:  # report and go on with the other queries
            problem = result = f"ERROR {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.1f}s {result}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
