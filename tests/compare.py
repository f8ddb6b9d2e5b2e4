"""Run every registered query and its SQL side by side; print what differs."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import __spark_entry__ as entry  # noqa: E402
from stallbook.plans.star import STAR_TABLES  # noqa: E402
from stallbook.session import local_session  # noqa: E402


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in STAR_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    return str(value) if isinstance(value, (datetime.date, datetime.datetime)) else value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, name, folder) -> str | None:
    """None when equal, else what differs first."""
    df = entry.queries()[name](spark, folder)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    ours = sorted((c, types.get(t, t)) for c, t in df.dtypes)
    theirs = sorted((d[0], str(d[1])) for d in cursor.description)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    ours, theirs = _sorted(df.columns, df.collect()), _sorted(names, cursor.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session, database_ = local_session(), database(sf)
    for query in wanted or entry.queries():
        start = time.time()
        try:
            result = differences(session, database_, query, sf) if query in entry.oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if result is None else 'DIFF'} {query} {time.time() - start:.2f}s {result or ''}", flush=True)
