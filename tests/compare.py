"""Run every registered query against its SQL; used by the tests and from the command line."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def difference(spark, connection, folder: str, query, sql: str) -> str | None:
    df = query(spark, folder)
    ours = rows(df.columns, df.collect())
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows / {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} / {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from journeylens.runtime import session

    spark = session(**{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    folder = sys.argv[1]
    wanted = sys.argv[2:]
    connection = duck(folder)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = difference(spark, connection, folder, query, sqls[name])
            else:
                problem = f"no SQL, {query(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"\n@@ {name} {time.time() - start:.1f}s {problem or 'ok'}", flush=True)
