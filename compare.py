"""Run registered queries next to their DuckDB SQL and report differences.

usage: python compare.py [data folder] [query name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from oracles import ORACLES
from registry import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(frame) -> list[tuple]:
    names = sorted(frame.columns)
    values = frame[names].astype(object).where(frame[names].notna(), None)
    return sorted((tuple(r) for r in values.itertuples(index=False)), key=repr)


def same(a, b) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return float(a) == float(b)
    return a == b


def normal(row: tuple) -> tuple:
    return tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in row)


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{Path(folder) / t}.parquet'")
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            got = QUERIES[name](spark, folder).toPandas()
            took = time.time() - started
            if name not in ORACLES:
                print(f"{name:36s} {len(got):7d} rows {took:6.2f}s  no SQL")
                continue
            want = con.execute(ORACLES[name]).fetchdf()
        except Exception as error:  # report and go on with the next query
            print(f"{name:36s} FAILED {type(error).__name__}: {str(error)[:600]}")
            bad += 1
            continue
        if sorted(got.columns) != sorted(want.columns):
            print(f"{name:36s} COLUMNS {sorted(set(got.columns) ^ set(want.columns))}")
            bad += 1
            continue
        a = sorted(map(normal, rows_of(got)), key=repr)
        b = sorted(map(normal, rows_of(want)), key=repr)
        if a == b:
            print(f"{name:36s} {len(a):7d} rows {took:6.2f}s  ok")
        else:
            bad += 1
            left, right = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
            print(f"{name:36s} DIFFERENT {len(a)} / {len(b)} rows, {len(left)} only here, {len(right)} only there")
            if left and right:
                for column, x, y in zip(sorted(got.columns), left[0], right[0]):
                    if not same(x, y):
                        print(f"      {column}: {x!r} / {y!r}")
            else:
                print("     ", (left or right)[:2])
    print("bad:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    arguments = sys.argv[1:]
    folder = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, arguments) else 0)
