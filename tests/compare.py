"""Run registered queries beside their SQL and compare the whole results."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return float(f"{float(value):.9g}")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, sql: str, con) -> str | None:
    """None when names, rows and values agree; else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, df.collect())
    if want != got:
        extra, lack = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n   only ours: {extra}\n   only sql:  {lack}"
    return None


def types_of(df, sql: str, con) -> list[str]:
    """Columns whose types look different between the engines."""
    same = {
        "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
        "float": "FLOAT",
    }
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n}:{t}/{described[n]}" for n, t in df.dtypes if n in described and same.get(t, t) != described[n]]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problem = differences(df, sqls[name], con)
                notes = types_of(df, sqls[name], con)
            else:
                problem, notes = None, [f"no SQL, {df.count()} rows"]
        except Exception as e:
            problem, notes = f"{type(e).__name__}: {str(e)[:1500]}", []
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {' '.join(notes)}", flush=True)
        if problem:
            print("   " + problem, flush=True)
    print("failed:", bad)
    spark.stop()
