"""Run every catalog query in Spark and its oracle SQL in DuckDB on one
benchmark directory; report row count, schema and value-hash agreement.

    python tests/compare.py [/root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if os.environ.get("COMPARE_EXACT") else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from riskmesh.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            st = time.time() - t0
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if name not in oracle:
            print(f"---- {name}: rows={len(srows)} (no oracle) {st:.1f}s")
            continue
        try:
            rel = con.sql(oracle[name])
            orows, ocols, otypes = rel.fetchall(), rel.columns, rel.types
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        hs, ls = digest(srows, scols)
        ho, lo = digest(orows, ocols)
        ok = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and hs == ho
        stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        print(f"{'ok  ' if ok else 'FAIL'} {name}: rows spark={len(srows)} duck={len(orows)} "
              f"cols_match={sorted(scols) == sorted(ocols)} hash={hs == ho} {st:.1f}s")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(ocols):
                print("   spark cols", scols, "\n   duck  cols", ocols)
            print("   spark types", stypes, "\n   duck types", dict(zip(ocols, map(str, otypes))))
            sd, od = set(ls), set(lo)
            print("   only spark:", sorted(sd - od)[:3])
            print("   only duck :", sorted(od - sd)[:3])
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
