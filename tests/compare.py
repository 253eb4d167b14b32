"""Run a registered query on Spark and its SQL on DuckDB, and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value)) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    return names, sorted(rows, key=repr)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    described = [d[0] for d in cursor.description]
    names = sorted(described)
    order = [described.index(n) for n in names]
    rows = [tuple(plain(r[i]) for i in order) for r in cursor.fetchall()]
    return names, sorted(rows, key=repr)


def difference(spark, folder, run, sql) -> str | None:
    names, ours = spark_rows(run(spark, folder))
    expected_names, theirs = duck_rows(connect(folder), sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    if not ours:
        return "no rows on either side"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    types = {(type(a), type(b)) for x, y in zip(ours, theirs) for a, b in zip(x, y)
             if a is not None and b is not None and type(a) is not type(b)}
    if types and not wrong:
        return f"types differ: {types}"
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} of {len(ours)} rows differ, first: {cells}"
    return None


def main():
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    folder = "/root/testdata/sf0.01"
    chosen = sys.argv[1:]
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, folder, run, oracles[name])
            else:
                problem = f"rows only: {len(run(spark, folder).collect())}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{time.time() - start:6.2f}s {name:28} {problem or 'ok'}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
