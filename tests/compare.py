"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/compare.py SF_DIR [name ...]
Prints one line per query: rows, column names and an order-insensitive hash.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import sys
import time
from pathlib import Path

import numpy as np
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, np.integer)):
        return int(v)  # exact, also above 2**53
    if isinstance(v, float) or hasattr(v, "dtype"):
        try:
            f = float(v)
        except (TypeError, ValueError):
            return str(v)
        if math.isnan(f):
            return None
        return int(f) if f.is_integer() else round(f, 6) + 0.0
    if isinstance(v, (datetime.datetime, pd.Timestamp)):
        ts = pd.Timestamp(v)
        return ts.date().isoformat() if ts == ts.normalize() else ts.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def frame_digest(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    rows = sorted(repr(tuple(_norm(x) for x in r)) for r in pdf.itertuples(index=False, name=None))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]
    return len(rows), cols, h, rows


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1]
    only = set(argv[2:])
    import __spark_entry__ as E
    from pitlane.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, osql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if name not in (only or osql):  # without names: all that have an oracle
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {exc!r}"[:400])
            bad += 1
            continue
        t1 = time.time()
        n1, c1, h1, r1 = frame_digest(sp)
        if name not in osql:
            print(f"{name:32s} rows={n1} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            dk = con.execute(osql[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:32s} DUCK-ERROR {exc!r}"[:600])
            bad += 1
            continue
        n2, c2, h2, r2 = frame_digest(dk)
        ok = (n1, c1, h1) == (n2, c2, h2)
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={n1}/{n2} {t1 - t0:.1f}s")
        if not ok:
            if c1 != c2:
                print("   cols spark:", c1, "\n   cols duck: ", c2)
            else:
                s1, s2 = set(r1), set(r2)
                print("   spark-only:", sorted(s1 - s2)[:3])
                print("   duck-only: ", sorted(s2 - s1)[:3])
                print("   dtypes spark:", dict(sp.dtypes.astype(str)), "\n   dtypes duck:", dict(dk.dtypes.astype(str)))
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
