"""Compare registered queries with their SQL: python -m checks.run [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks import load_all
from checks.framework import CHECKS, spark_query
from checks.views import TABLES
from hopscan.session import use_temporary_folder


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("checks")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_temporary_folder(spark)
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_of(columns: list[str], data: list[tuple]) -> tuple[list[str], Counter]:
    """Order-free view of a result: columns by name, rows as a multiset."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(repr(r[i]) for i in order) for r in data)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> tuple[bool, str]:
    item = CHECKS[name]
    t0 = time.time()
    df = spark_query(item)(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    if item.sql is None:
        return True, f"rows only: {sum(got[1].values())} rows, {t1 - t0:.1f}s"
    cur = con.execute(item.sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    t2 = time.time()
    text = f"{sum(got[1].values())} rows, {t1 - t0:.1f}s / {t2 - t1:.1f}s"
    if got[0] != want[0]:
        return False, f"{text} columns {got[0]} vs {want[0]}"
    if got[1] != want[1]:
        extra, lack = got[1] - want[1], want[1] - got[1]
        return False, (f"{text} sql {sum(want[1].values())} rows; {got[0]}\n   spark only {sum(extra.values())}: "
                       f"{sorted(extra)[:2]}\n   sql only {sum(lack.values())}: {sorted(lack)[:2]}")
    return True, text


def main(argv: list[str]) -> int:
    load_all()
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(CHECKS)
    spark, con = session(), connect(sf_dir)
    bad = []
    for name in names:
        try:
            ok, text = compare(spark, con, sf_dir, name)
        except Exception as e:  # report every query, whatever fails
            ok, text = False, f"{type(e).__name__}: {str(e)[:700]}"
        print(("ok   " if ok else "FAIL ") + name + ": " + text, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
