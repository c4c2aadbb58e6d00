"""Compare a registered Spark query with its DuckDB SQL: column names, row count and the multiset of
normalised rows (floats compared after rounding, timestamps as naive datetimes)."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):  # numpy scalars
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None):
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    spark_rows = [r.asDict() for r in sdf.collect()]
    t_spark = time.time() - t0
    scols = sorted(sdf.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: rows-only ({len(spark_rows)} rows) {t_spark:.1f}s"
    rel = con.sql(sql)
    dcols = sorted(rel.columns)
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    if scols != dcols:
        return False, f"{name}: columns differ spark={scols} duck={dcols}"
    if len(spark_rows) != len(drows):
        return False, f"{name}: row count spark={len(spark_rows)} duck={len(drows)}"
    a, b = _rows(spark_rows, scols), _rows(drows, dcols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"{name}: values differ, e.g. {diff}"
    return True, f"{name}: equal ({len(a)} rows) {t_spark:.1f}s"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from sluice.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    import __spark_entry__ as entry

    con = duck(sf)
    bad = 0
    for n in names or list(entry.queries()):
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK  " if ok else "FAIL") + " " + msg, flush=True)
    print(f"{bad} failing")
