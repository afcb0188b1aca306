"""Runs registered queries in Spark and their SQL in DuckDB and compares rows."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import glob
import os
import sys
import time

import duckdb

# How DuckDB names the types that Spark returns.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return value + 0.0  # exact, but for the sign of zero
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a Spark result and a DuckDB result; empty when they agree."""
    relation = connection.sql(sql)
    expected = dict(zip(relation.columns, map(str, relation.types)))
    found = {n: TYPES.get(t, t.upper()) for n, t in df.dtypes}
    problems = []
    if found != expected:
        problems.append(f"schema: {sorted(set(found.items()) ^ set(expected.items()))}")
    if set(found) == set(expected):
        left, right = _bag(df.columns, df.collect()), _bag(relation.columns, relation.fetchall())
        if left != right:
            extra, missing = left - right, right - left
            problems.append(
                f"rows: {left.total()} against {right.total()}, extra {list(extra)[:2]}, missing {list(missing)[:2]}"
            )
        if not left:
            problems.append("no rows")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from daybook.session import local_session

    spark, connection = local_session(8), duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problems = differences(df, connection, oracles[name]) if name in oracles else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # report every query, whatever one of them does
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems) and name in oracles
        print(f"{name:34s} {time.time() - start:6.2f}s  {problems or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
