"""Run catalog queries in Spark and their oracle SQL in DuckDB, and compare the results.

Used by the test-suite and runnable by hand::

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]

Rows are compared as sorted multisets after normalising types (timestamps to
naive datetimes, numbers to float). Collecting is fine here: this is test code on
small fixtures.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        f = float(value)
        if math.isnan(f):
            return "NaN"
        return round(f, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "item"):
        return _norm(value.item())
    return str(value)


def _key(row):
    return tuple((v is None, "" if v is None else str(type(v)), v if v is not None else 0) for v in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark, sf_dir: str, names=None, verbose: bool = True) -> dict:
    from __spark_entry__ import oracle_sql, queries

    qs = queries()
    sql = oracle_sql()
    con = duck_connection(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        t1 = time.time()
        entry = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in sql:
            res = con.execute(sql[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
            sc, sr = normalise(s_cols, s_rows)
            dc, dr = normalise(d_cols, d_rows)
            entry.update(
                oracle_rows=len(d_rows),
                columns_match=sc == dc,
                rows_match=sr == dr,
            )
            if sr != dr:
                sset, dset = set(sr), set(dr)
                entry["only_spark"] = [r for r in sr if r not in dset][:3]
                entry["only_oracle"] = [r for r in dr if r not in sset][:3]
            if sc != dc:
                entry["spark_columns"], entry["oracle_columns"] = sc, dc
        report[name] = entry
        if verbose:
            print(name, entry, flush=True)
    return report


def main(argv):
    from refillscope.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    report = compare(spark, sf_dir, argv[2:] or None)
    bad = [k for k, v in report.items() if not (v.get("rows_match", True) and v.get("columns_match", True))]
    print("MISMATCH:", bad if bad else "none")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
