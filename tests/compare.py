"""Run registered queries in Spark and their SQL in DuckDB, and compare all values.

``python tests/compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowspark import catalog  # noqa: E402
from flowspark.catalog.derived import TABLES  # noqa: E402
from flowspark.session import local_session  # noqa: E402


def plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, decimal.Decimal):
        return f"DECIMAL {value}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    """None where both sides agree, else a short account of the difference."""
    df = catalog.queries()[name](spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(rel.columns)}"
    theirs = rows(rel.columns, rel.fetchall())
    if mine == theirs:
        return None if mine else "both empty"
    a, b = set(mine), set(theirs)
    return f"{len(mine)} vs {len(theirs)} rows; only spark {sorted(a - b)[:2]}; only sql {sorted(b - a)[:2]}"


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = oracle(sf)
    names = [n for n in catalog.queries() if not args or any(n.startswith(a) for a in args)]
    bad = 0
    for n in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf, n)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        count = "" if n in catalog.oracle_sql() else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {n}{count} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
