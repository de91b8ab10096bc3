"""Run named queries next to their SQL twins: ``python tests/compare.py [sf_dir] [name …]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("assetlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """A value in a form that is equal for both engines."""
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        if math.isnan(number):
            return "nan"
        return 0.0 if number == 0 else round(number, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((str(k), plain(v)) for k, v in value.items()))
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return table(columns, result.fetchall())


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    oracles, bad = entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            got = spark_table(entry.queries()[name](spark, sf_dir))
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"rows  {name}: {len(got[1])} rows {took:.1f}s {got[1][:2]}"[:400], flush=True)
            continue
        try:
            want = duck_table(con, oracles[name])
        except Exception as error:
            bad += 1
            print(f"ORACLE {name}: {str(error)[:1500]}", flush=True)
            continue
        if got == want:
            print(f"ok    {name}: {len(got[1])} rows {took:.1f}s", flush=True)
        else:
            bad += 1
            only_got = [r for r in got[1] if r not in set(want[1])][:3]
            only_want = [r for r in want[1] if r not in set(got[1])][:3]
            print(f"DIFF  {name}: {got[0]} {want[0]} {len(got[1])}/{len(want[1])}", flush=True)
            print(f"      spark {str(only_got)[:900]}\n      duck  {str(only_want)[:900]}", flush=True)
    print(f"{bad} bad of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
