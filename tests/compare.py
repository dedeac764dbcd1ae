"""Run registered queries next to their SQL and report differences."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def difference(spark, con, folder, query, sql) -> tuple[str, float, int]:
    """An empty text if query and SQL agree, what differs otherwise; seconds and rows."""
    start = time.time()
    df = query(spark, folder)
    got = df.collect()
    seconds = time.time() - start
    found = con.execute(sql)
    names = [column[0] for column in found.description]
    want = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", seconds, len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", seconds, len(got)
    left, right = rows_of(df.columns, got), rows_of(names, want)
    for a, b in zip(left, right):
        if a != b:
            return f"columns {sorted(names)}: {a} != {b}", seconds, len(got)
    return "", seconds, len(got)


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tallyhouse.session import local_session

    folder, *wanted = sys.argv[1:]
    spark = local_session("compare")
    con, registered, sql = connect(folder), queries(), oracle_sql()
    print("without sql:", sorted(set(registered) - set(sql)), sorted(set(sql) - set(registered)))
    bad = 0
    for name, query in registered.items():
        if name not in sql or (wanted and name not in wanted):
            continue
        try:
            text, seconds, rows = difference(spark, con, folder, query, sql[name])
        except Exception as error:
            text, seconds, rows = "ERROR " + str(error)[:900], 0.0, 0
        bad += bool(text)
        print(f"{'BAD' if text else 'ok ':4}{name:32}{seconds:7.2f}s {rows:7} {text}", flush=True)
    print("different:", bad)
