"""Compare registered queries with their SQL on DuckDB: python tests/compare.py [names] (SF_DIR)."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if not bad:
        return None
    only_l = set(left[1]) - set(right[1])
    only_r = set(right[1]) - set(left[1])
    return f"{len(only_l)} rows differ, e.g. spark {sorted(only_l, key=repr)[:2]} duckdb {sorted(only_r, key=repr)[:2]}"


def main() -> int:
    import __spark_entry__ as entry
    from arterial.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            left = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - start
            if name not in oracles:
                print(f"{name:24s} rows {len(left[1])} (no oracle) {took:.1f}s", flush=True)
                continue
            t0 = time.time()
            diff = difference(left, duck_rows(con, oracles[name]))
            print(f"{name:24s} {'ok' if diff is None else 'DIFF ' + diff} rows {len(left[1])} spark {took:.1f}s duckdb {time.time() - t0:.1f}s", flush=True)
            failed += diff is not None
        except Exception as error:  # report and go on with the other queries
            failed += 1
            print(f"{name:24s} ERROR {type(error).__name__}: {str(error)[:700]}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
