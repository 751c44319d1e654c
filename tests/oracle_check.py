"""Spark vs DuckDB check in the driver's manner: row count, column names and an
order-insensitive hash of the values.  Usage:
    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# ORACLE_EXACT=1 compares floats bit for bit instead of to 9 digits.
EXACT = os.environ.get("ORACLE_EXACT") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone = 'UTC'")
    return con


def check(spark, sf_dir, keys=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[k] = ("spark-error", str(e)[:300])
            print(k, "SPARK ERROR", str(e)[:500]) if verbose else None
            continue
        st = time.time() - t
        if k not in sqls:
            results[k] = ("no-oracle", len(srows))
            print(f"{k}: spark rows={len(srows)} (no oracle) {st:.1f}s") if verbose else None
            continue
        try:
            cur = con.execute(sqls[k])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = ("oracle-error", str(e)[:300])
            print(k, "ORACLE ERROR", str(e)[:500]) if verbose else None
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = _rows(scols, srows), _rows(dcols, drows)
        ok = ok_cols and a == b
        results[k] = ("match" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            print(f"{k}: {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} {st:.1f}s")
            if not ok_cols:
                print("   cols only spark:", sorted(set(scols) - set(dcols)),
                      "only duck:", sorted(set(dcols) - set(scols)))
            elif a != b:
                names = sorted(scols)
                sa, sb = set(a), set(b)
                da, db = sorted(sa - sb, key=repr)[:2], sorted(sb - sa, key=repr)[:2]
                for x, y in zip(da, db):
                    diff = [(n, u, v) for n, u, v in zip(names, x, y) if u != v]
                    print("   diff:", diff[:6])
                if not da or not db:
                    print("   only spark:", da[:2], "only duck:", db[:2])
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    if os.environ.get("ORACLE_PLAIN_SESSION") == "1":
        # Spark defaults (200 shuffle partitions, session time zone of the host).
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false") \
            .getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from berthline.session import build_session
        spark = build_session()
    res = check(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("match", "no-oracle")}
    print("SUMMARY", len(res), "checked;", len(bad), "not matching:", sorted(bad))
