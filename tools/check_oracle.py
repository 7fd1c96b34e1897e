"""Compare every registered Spark query with its DuckDB oracle.

    python tools/check_oracle.py [sf_dir] [query ...]

Prints one line per query: row counts, column names, and whether the
order-insensitive row multisets are equal (exact, and with a 1e-9 float
tolerance).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quietude.plans.catalog import QUERIES  # noqa: E402
from quietude.plans.oracle import oracle_sql  # noqa: E402
from quietude.session import get_session  # noqa: E402
from quietude.sources.tables import DRIVER_TABLES  # noqa: E402


def _norm(v, tol):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 9) if tol else v)
    if hasattr(v, "isoformat"):
        return (3, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return (2, float(v) if tol else v)
    return (4, str(v))


def _family(type_name: str) -> str:
    t = type_name.lower()
    if t in ("bigint", "int", "integer", "smallint", "tinyint", "hugeint", "long"):
        return "integer"
    if t in ("double", "float", "real") or t.startswith("decimal"):
        return "number"
    if t in ("string", "varchar") or t.startswith("varchar"):
        return "text"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def _rows(records, cols, tol):
    return sorted(tuple(_norm(r[c], tol) for c in cols) for r in records)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = oracle_sql()
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-FAIL {name}: {str(e)[:400]}")
            bad += 1
            continue
        if name not in sqls:
            print(f"NO-ORACLE  {name}: spark rows={len(srows)}")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            dtypes = {d[0]: str(d[1]) for d in cur.description}
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-FAIL  {name}: {str(e)[:400]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(dcols)
        stypes = dict(sdf.dtypes)
        type_diff = [(c, stypes[c], dtypes[c]) for c in scols
                     if c in dtypes and _family(stypes[c]) != _family(dtypes[c])]
        if type_diff:
            print(f"TYPES      {name}: {type_diff}")
        cols = sorted(scols)
        exact = same_cols and _rows(srows, cols, False) == _rows(drows, cols, False)
        close = same_cols and _rows(srows, cols, True) == _rows(drows, cols, True)
        status = "OK" if exact else ("CLOSE" if close else "MISMATCH")
        if status != "OK":
            bad += 1
        print(f"{status:10s} {name:24s} spark={len(srows):6d} duck={len(drows):6d} "
              f"cols={'same' if same_cols else (scols, dcols)} {time.time() - t0:.1f}s")
        if status == "MISMATCH" and same_cols:
            a, b = _rows(srows, cols, True), _rows(drows, cols, True)
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            print("   spark-only:", diff_a)
            print("   duck-only: ", diff_b)
    print(f"{bad} problem(s)")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
