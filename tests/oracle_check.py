"""Run registered queries in Spark and their SQL in DuckDB, and compare results.

    python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names, same row count, and equal multisets of rows
(floats compared exactly and, if that fails, with a 1e-9 relative tolerance).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, v, math.copysign(1.0, v) if v == 0 else 0.0)  # -0.0 and 0.0 hash differently
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (2, float(v), 1.0 if v == 0 else 0.0)
    return (4, str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in rows], key=repr)


def close(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for ta, tb in zip(ra, rb):
            ka, va, kb, vb = ta[0], ta[1], tb[0], tb[1]
            if ka != kb:
                return False
            if ka == 2:
                if not math.isclose(va, vb, rel_tol=1e-9, abs_tol=1e-12):
                    return False
            elif va != vb:
                return False
    return True


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
                 "tinyint": "TINYINT", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_diffs(sdf, con, sql):
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, dtypes.get(c)) for c, t in stypes.items() if SPARK_TO_DUCK.get(t, t) != dtypes.get(c)}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, status="no-oracle", rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        out["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return out
    td = type_diffs(sdf, con, sql)
    if td:
        out["types"] = td
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a == b:
        out["status"] = "exact"
    elif close(a, b):
        out["status"] = "close"
    else:
        out["status"] = "MISMATCH"
        diff = [x for x in a if x not in b][:3]
        diff2 = [x for x in b if x not in a][:3]
        out["spark_only"] = diff
        out["oracle_only"] = diff2
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as ent
    from raresight.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = ent.queries(), ent.oracle_sql()
    bad = 0
    for name in (names or sorted(qs)):
        try:
            r = compare(spark, con, name, qs[name], orc.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = dict(name=name, status=f"ERROR {type(exc).__name__}: {str(exc)[:400]}")
        bad += r["status"] not in ("exact", "close", "no-oracle") or "types" in r
        print(r, flush=True)
    print(f"{len(names or qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
