"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Comparison: same row count, same column names and types, same multiset of rows
(columns sorted by name; timestamps as ISO text; doubles to 9 significant digits).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


# Spark type -> DuckDB type name, for the schema part of the comparison.
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "boolean": "BOOLEAN", "binary": "BLOB"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
            t1 = time.time()
            if name not in sql:
                results[name] = ("rows-only", len(srows))
                continue
            rel = con.sql(sql[name])
            dcols = rel.columns
            dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            drows = rel.fetchall()
            sc, sr = canon(scols, srows)
            dc, dr = canon(dcols, drows)
            ok = sc == dc and stypes == dtypes and len(sr) == len(dr) and sr == dr
            detail = ""
            if not ok:
                if sc != dc:
                    detail = f"cols spark={sc} duck={dc}"
                elif stypes != dtypes:
                    detail = f"types spark={stypes} duck={dtypes}"
                elif len(sr) != len(dr):
                    detail = f"rows spark={len(sr)} duck={len(dr)}"
                else:
                    diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                    detail = f"values differ e.g. {diff}"
            results[name] = ("OK" if ok else "MISMATCH", len(srows), round(t1 - t0, 2), detail)
        except Exception as exc:  # report and continue
            results[name] = ("ERROR", repr(exc)[:600])
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from gearwatch.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle-check", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("BAD:", bad)
