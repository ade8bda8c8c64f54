"""Compare every registered query with its SQL oracle; used by the tests and from the shell.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if equal, else a description of the difference."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        return (
            f"rows {sum(got.values())} vs {sum(want.values())}; only spark: "
            f"{list((got - want).items())[:2]}; only sql: {list((want - got).items())[:2]}"
        )
    return None


if __name__ == "__main__":
    from conftest import make_session

    folder, wanted = sys.argv[1], sys.argv[2:] or list(entry.queries())
    session, connection = make_session(), connect(folder)
    failed = []
    for query in wanted:
        start = time.time()
        if query not in entry.oracle_sql():
            print(f"{query:30} rows only: {entry.queries()[query](session, folder).count()}")
            continue
        try:
            problem = compare(session, connection, folder, query)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += [query] if problem else []
        print(f"{query:30} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} ok; failed: {failed}")
