"""Run every registered query with Spark and its oracle with DuckDB, compare.

Usage: python tests/contract_check.py [sf_dir] [name ...]
Prints one line per query: name, rows spark/oracle, schema match, value match, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from loamflow.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if os.environ.get("EXACT") else round(v, 9)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    spark = get_spark(cores=8)
    oracle = E.oracle_sql()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"{name:28s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        secs = time.time() - t0
        if name not in oracle:
            print(f"{name:28s} rows={len(rows):6d} (no oracle) {secs:6.1f}s")
            continue
        try:
            res = con.execute(oracle[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:
            print(f"{name:28s} ORACLE ERROR {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(cols) == sorted(ocols)
        dmap = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                "BOOLEAN": "boolean", "FLOAT": "float", "DATE": "date", "HUGEINT": "hugeint"}
        otypes = {d[0]: dmap.get(str(d[1]), str(d[1])) for d in res.description}
        stypes = dict(df.dtypes)
        tdiff = {c: (stypes.get(c), otypes.get(c)) for c in otypes if stypes.get(c) != otypes.get(c)}
        if tdiff:
            print(f"   type differences: {tdiff}")
        same = same_cols and _rows(rows, cols) == _rows(orows, ocols)
        flag = "OK " if same else "BAD"
        if not same:
            bad += 1
        print(f"{name:28s} {flag} rows={len(rows)}/{len(orows)} cols={'same' if same_cols else (cols, ocols)} {secs:6.1f}s")
        if not same and same_cols:
            a, b = _rows(rows, cols), _rows(orows, ocols)
            diff = [x for x in a if x not in set(b)][:3]
            print("   spark-only:", diff)
            print("   oracle-only:", [x for x in b if x not in set(a)][:3])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
