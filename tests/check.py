"""Compare registered queries with their SQL: ``python tests/check.py sf_dir [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return normal([c[0] for c in cursor.description], cursor.fetchall())


def main(sf_dir, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            got = spark_result(queries[name](spark, sf_dir))
            took = time.time() - start
            if name not in sql:
                print(f"rows  {name} {len(got[1])} {took:.2f}s", flush=True)
                continue
            want = sql_result(con, sql[name])
        except Exception as e:
            bad += 1
            print(f"ERROR {name}: {str(e)[:1500]}", flush=True)
            continue
        if got == want:
            print(f"ok    {name} {len(got[1])} {took:.2f}s", flush=True)
        else:
            bad += 1
            print(f"DIFF  {name} {len(got[1])} vs {len(want[1])} {got[0]} {want[0]}", flush=True)
            extra, lost = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
            print("   spark only:", sorted(extra)[:3], "\n   sql only:  ", sorted(lost)[:3])
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
