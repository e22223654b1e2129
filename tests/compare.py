"""Run registered queries in Spark and their SQL in DuckDB and compare: names, rows and values."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, Decimal):
        return ("decimal", str(v))
    return v


def rows_of(columns, raw):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in raw), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for f in sorted(f for f in os.listdir(sf_dir) if f.endswith(".parquet")):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def compare(spark, con, name, make, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = make(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
            return f"first difference {diff[:4]}"
    return None


def main(sf_dir="/root/testdata/sf0.01", only=()):
    from __spark_entry__ import oracle_sql, queries
    from ledgerloom.session import local_session

    spark = local_session("compare")
    con, oracles, bad = connect(sf_dir), oracle_sql(), []
    for name, make in queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, make, oracles[name], sf_dir)
            else:
                problem = None if make(spark, sf_dir).count() >= 0 else "?"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - t:6.2f}s {name} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} differ: {bad}")


if __name__ == "__main__":
    main(*(sys.argv[1:2] or ["/root/testdata/sf0.01"]), only=sys.argv[2:])
