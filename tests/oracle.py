"""Run a query and its oracle side by side and compare all rows.

``python -m tests.oracle [key ...]`` checks the named queries, or all.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def row_counts(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


# Spark type against DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        expected = TYPES.get(field.dataType.simpleString())
        if expected != kinds[field.name]:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} against {kinds[field.name]}")
    ours, theirs = row_counts(df.columns, rows), row_counts(names, result.fetchall())
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"{sum(ours.values())} rows against {sum(theirs.values())}")
    if ours != theirs:
        found.append(f"only ours {list((ours - theirs).items())[:2]}, only theirs {list((theirs - ours).items())[:2]}")
    return found


def main(keys: list[str], folder: str) -> None:
    from mattercat.session import build_session
    from workload import ORACLES, QUERIES

    spark: SparkSession = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            df = QUERIES[key](spark, folder)
            found = differences(df, con, ORACLES[key]) if key in ORACLES else (
                [] if df.count() else ["no rows"])
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {key} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} failed")
    spark.stop()


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        folder = args.pop(0)
    main(args, folder)
