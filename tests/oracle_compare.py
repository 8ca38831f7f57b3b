"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Compares row count, column names and types, and an order-insensitive hash of the values.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from webloom.sources.pages import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(lines), h, lines


def duck_con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_SPARK_TO_DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER",
                  "double": "DOUBLE", "timestamp": "TIMESTAMP", "binary": "BLOB"}


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    return cols, rows


def spark_types(df):
    return {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck_con(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            stypes = spark_types(sdf)
            cols, rows = spark_rows(sdf)
        except Exception as e:  # pragma: no cover
            results[name] = ("SPARK_ERROR", str(e)[:500])
            print(name, "SPARK_ERROR", str(e)[:2000]) if verbose else None
            continue
        t1 = time.time()
        if name not in sql:
            results[name] = ("ROWS_ONLY", len(rows))
            print(f"{name}: rows-only {len(rows)} rows ({t1 - t0:.1f}s)") if verbose else None
            continue
        try:
            rel = con.sql(sql[name])
            dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
            dcols, drows = rel.columns, rel.fetchall()
        except Exception as e:  # pragma: no cover
            results[name] = ("DUCK_ERROR", str(e)[:500])
            print(name, "DUCK_ERROR", str(e)[:2000]) if verbose else None
            continue
        sc, sn, sh, sl = table_digest(cols, rows)
        dc, dn, dh, dl = table_digest(dcols, drows)
        types_ok = stypes == dtypes
        ok = sc == dc and sn == dn and sh == dh and types_ok
        results[name] = ("OK" if ok else "MISMATCH", sn, dn)
        if verbose:
            print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={sn} duck={dn} ({t1 - t0:.1f}s)")
            if not ok:
                if sc != dc:
                    print("  cols", sc, dc)
                if not types_ok:
                    print("  types", stypes, dtypes)
                ss, ds = set(sl), set(dl)
                for x in list(ss - ds)[:3]:
                    print("  spark only:", x[:300])
                for x in list(ds - ss)[:3]:
                    print("  duck only: ", x[:300])
    return results


if __name__ == "__main__":
    from webloom.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "ROWS_ONLY")}
    print("SUMMARY", len(res) - len(bad), "ok /", len(res), "bad:", sorted(bad))
