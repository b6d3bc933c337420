"""Compare registered queries with their SQL twins: python tests/check_oracles.py [sf_dir] [name...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    """Empty if the query equals its twin, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = [r for r in got[1] if r not in set(want[1])][:3]
        lacking = [r for r in want[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} rows, {len(want[1])} expected; extra {extra} lacking {lacking}"
    return ""


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), connect(sf_dir)
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
