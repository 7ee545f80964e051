"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Mirrors the driver's check: same column names, same row count and the same
multiset of rows (floats compared after rounding to 6 places).

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return [cols[i] for i in order], out


def compare(spark, sf_dir, names=None, con=None, verbose=True):
    from paddock.plans.catalog import ORACLES, QUERIES, load_all
    load_all()
    con = con or duck(sf_dir)
    names = names or sorted(QUERIES)
    result = {}
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            result[name] = f"spark error: {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, result[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in ORACLES:
            result[name] = f"rows-only ({len(srows)} rows)"
            if verbose:
                print(f"{name:32s} {result[name]} {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(ORACLES[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            result[name] = f"oracle error: {str(e)[:300]}"
            if verbose:
                print(name, result[name], flush=True)
            continue
        sc, sr = rows_of(scols, srows)
        dc, dr = rows_of(dcols, drows)
        if sc != dc:
            status = f"COLUMNS differ spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            status = f"ROWCOUNT spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            bad = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            status = f"VALUES differ e.g. {bad}"
        else:
            status = "ok"
        result[name] = status
        if verbose:
            print(f"{name:32s} {status[:600]} rows={len(sr)} {ts:.1f}s", flush=True)
    return result


if __name__ == "__main__":
    from paddock.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v != "ok" and not v.startswith("rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
