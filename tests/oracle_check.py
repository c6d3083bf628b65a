"""Compare every registered query with its DuckDB oracle (what the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match, value match, seconds.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from planpulse.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


STRICT = "--strict" in sys.argv


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(v)) if STRICT else (1, f"{round(v, 6):.6f}")
    if isinstance(v, bool):
        return (1, str(v))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, str([norm(x) for x in v]))
    try:
        from decimal import Decimal
        if isinstance(v, Decimal):
            return (1, f"{float(v):.6f}")
    except Exception:
        pass
    if isinstance(v, int):
        return (1, f"{float(v):.6f}") if False else (1, str(v))
    return (1, str(v))


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[2:] if not a.startswith("--")]
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, d)
            cols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt_s = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} rows={len(srows):7d} (no oracle) {dt_s:6.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [c[0] for c in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:24s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        cmatch = sorted(cols) == sorted(ocols)
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}
        stypes = {f.name: tmap.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema}
        otypes = {c[0]: str(c[1]) for c in res.description}
        tdiff = {c: (stypes[c], otypes.get(c)) for c in stypes if c in otypes and stypes[c] != otypes[c]}
        if tdiff:
            print(f"   type differences: {tdiff}")
        if cmatch:
            order = [ocols.index(c) for c in sorted(cols)]
            sorder = [cols.index(c) for c in sorted(cols)]
            a = sorted(tuple(norm(r[i]) for i in sorder) for r in srows)
            b = sorted(tuple(norm(r[i]) for i in order) for r in orows)
            vmatch = a == b
        else:
            vmatch = False
        ok = cmatch and vmatch and len(srows) == len(orows)
        bad += 0 if ok else 1
        print(f"{name:24s} rows={len(srows):7d}/{len(orows):7d} cols={'ok' if cmatch else 'DIFF'} "
              f"values={'ok' if vmatch else 'DIFF'} {dt_s:6.1f}s")
        if not cmatch:
            print("   spark:", cols, "\n   duck: ", ocols)
        elif not vmatch:
            sa, sb = set(a), set(b)
            print("   only spark:", list(sa - sb)[:3])
            print("   only duck: ", list(sb - sa)[:3])
    print("MISMATCHES:", bad)


if __name__ == "__main__":
    main()
