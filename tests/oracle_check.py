"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from shelfcast.sources.tables import TABLES, table_path  # noqa: E402


# Spark simple type name -> DuckDB type name, for the schema part of the comparison.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def canon(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"{name}: rows-only {len(srows)} ({t1 - t0:.1f}s)"
    rel = con.sql(sql)
    dcols = list(rel.columns)
    dtypes = {c: str(t) for c, t in zip(dcols, rel.types)}
    drows = rel.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"{name}: COLUMNS DIFFER spark={scols} duck={dcols}"
    stypes = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    if stypes != dtypes:
        diff = {c: (stypes[c], dtypes[c]) for c in stypes if stypes[c] != dtypes[c]}
        return f"{name}: TYPES DIFFER {diff}"
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if len(a) != len(b):
        return f"{name}: ROWCOUNT spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"{name}: VALUES DIFFER ({sum(x != y for x, y in zip(a, b))} rows) e.g. {diff}"
    return f"{name}: OK {len(a)} rows ({t1 - t0:.1f}s)"


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from shelfcast.plans.registry import ORACLE, QUERIES, load_all
    from shelfcast.session import build_session
    load_all()
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    names = args or sorted(QUERIES)
    bad = 0
    for n in names:
        try:
            msg = compare(spark, con, n, QUERIES[n], ORACLE.get(n), sf_dir)
        except Exception as e:  # report and continue
            msg = f"{n}: ERROR {type(e).__name__}: {str(e)[:600]}"
        if "OK" not in msg and "rows-only" not in msg:
            bad += 1
        print(msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")


if __name__ == "__main__":
    main()
