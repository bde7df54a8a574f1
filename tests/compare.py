"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [folder] [names...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = [tuple(normal(r[i]) for i in order) for r in rows]
    return names, sorted(data, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else the first difference."""
    names, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    expected_names, expected = table([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for left, right in zip(got, expected):
        if left != right:
            return f"{dict(zip(names, left))} != {dict(zip(names, right))}"
    kinds = [{type(v) for row in side for v in row if v is not None} for side in (got, expected)]
    return None if kinds[0] == kinds[1] else f"types {kinds}"


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from motorlytics.session import build_session

    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql, failed = duck(folder), contract.queries(), contract.oracle_sql(), 0
    print("SQL without a query:", set(sql) - set(queries), flush=True)
    for name in names or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            problem = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem) and not problem.startswith("rows only")
        print(f"{name:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    sys.exit(min(main(where, arguments), 1))
