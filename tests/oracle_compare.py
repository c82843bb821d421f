"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if v is None or (v.__class__.__name__ in ("NAType", "NaTType")):
        return None
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return cols, sorted(out, key=key)


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    sdf = build(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(sdf), "spark_s": round(t1 - t0, 2)}
    odf = con.execute(sql).df()
    scols, srows = rows_of(sdf)
    ocols, orows = rows_of(odf)
    status = "ok"
    detail = ""
    if scols != ocols:
        status, detail = "schema", f"spark={scols} oracle={ocols}"
    elif len(srows) != len(orows):
        status, detail = "rows", f"spark={len(srows)} oracle={len(orows)}"
    else:
        exact = srows == orows
        if not exact:
            bad = 0
            first = None
            for a, b in zip(srows, orows):
                for x, y in zip(a, b):
                    same = x == y or (x is None and (y is None or (isinstance(y, float) and math.isnan(y))))
                    if not same and isinstance(x, float) and isinstance(y, float):
                        same = abs(x - y) <= 1e-9 * max(1.0, abs(x))
                    if not same:
                        bad += 1
                        first = first or (a, b)
                        break
            status = "approx" if bad == 0 else "values"
            detail = f"{bad} differing rows; first={first}" if bad else ""
    return {"name": name, "status": status, "rows": len(srows), "spark_s": round(t1 - t0, 2), "detail": detail[:600]}


def main(argv):
    sys.path.insert(0, ".")
    from wellscore.plans.registry import REGISTRY
    from wellscore.plans.queries import queries  # noqa: F401
    from wellscore.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(REGISTRY)
    spark = local_session(8)
    con = duck(sf_dir)
    results = []
    for n in names:
        e = REGISTRY[n]
        try:
            r = compare(spark, con, n, e.build, e.sql, sf_dir)
        except Exception as ex:  # report and continue
            r = {"name": n, "status": "error", "detail": repr(ex)[:600]}
        results.append(r)
        print(r, flush=True)
    bad = [r for r in results if r["status"] not in ("ok", "rows-only", "approx")]
    print(f"SUMMARY {len(results) - len(bad)}/{len(results)} passed; failing: {[r['name'] for r in bad]}")
    return results


if __name__ == "__main__":
    main(sys.argv)
