"""Compare each registered Spark query with its DuckDB oracle SQL on one scale factor.

Usage: python tests/oracle_compare.py [--out report.json] [sf_dir] [name ...]
Prints one line per query (and optionally writes them as JSON); exits non-zero on any
mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return [cols[i] for i in order], out


def compare(spark, sf_dir: str, names=None, con=None, verbose=True) -> dict:
    from gavlake import oracle
    from gavlake.queries import REGISTRY as qs
    sqls = oracle.sql()
    con = con or duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:28s} SPARK_ERROR {str(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("ROWS_ONLY", len(srows))
            if verbose:
                print(f"{name:28s} rows-only rows={len(srows)} spark={ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK_ERROR", str(e)[:400])
            if verbose:
                print(f"{name:28s} DUCK_ERROR {str(e)[:400]}", flush=True)
            continue
        sc, sv = canon(scols, srows)
        dc, dv = canon(dcols, drows)
        ok = sc == dc and sv == dv
        status = "OK" if ok else "MISMATCH"
        results[name] = (status, len(srows), len(drows))
        if verbose:
            msg = f"{name:28s} {status} rows spark={len(srows)} duck={len(drows)} spark={ts:.1f}s"
            if sc != dc:
                msg += f"\n   cols spark={sc}\n   cols duck ={dc}"
            elif not ok:
                sset, dset = set(sv), set(dv)
                msg += f"\n   only spark: {sorted(sset - dset)[:3]}\n   only duck : {sorted(dset - sset)[:3]}"
            print(msg, flush=True)
    return results


if __name__ == "__main__":
    import json

    from gavlake.session import build_session
    args = sys.argv[1:]
    out = None
    if args[:1] == ["--out"]:
        out, args = args[1], args[2:]
    sf = args[0] if args else "/root/testdata/sf0.001"
    names = args[1:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    if out:
        with open(out, "w", encoding="utf-8") as fh:
            json.dump({k: list(v) for k, v in res.items()}, fh, indent=1, sort_keys=True)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")]
    print("FAILED:", bad)
    sys.exit(1 if bad else 0)
