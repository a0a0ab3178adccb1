"""Compares queries with their SQL: python -m tests.llm.oracle NAME... (a development aid)."""

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def rows(table: list[tuple]) -> list[tuple]:
    clean = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in table]
    return sorted(clean, key=lambda r: tuple((x is not None, str(x)) for x in r))


def compare(spark, name: str, query, sql: str, folder: str) -> str:
    df = query(spark, folder)
    cols = sorted(df.columns)
    ours = rows([tuple(r) for r in df.select(*cols).collect()])
    rel = connect(folder).sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} and {sorted(rel.columns)}"
    theirs = rows(connect(folder).sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())
    if ours == theirs:
        return ""
    odd = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(ours)} and {len(theirs)} rows, {len(odd)} differ: {odd[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as e

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
        "spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[1:] or e.queries():
        t = time.time()
        if name in e.oracle_sql():
            print(name, compare(spark, name, e.queries()[name], e.oracle_sql()[name], folder) or "equal", f"{time.time() - t:.1f} s", flush=True)
        else:
            print(name, e.queries()[name](spark, folder).count(), "rows", f"{time.time() - t:.1f} s", flush=True)
