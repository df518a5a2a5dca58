"""Run registered queries in Spark and their SQL oracles in DuckDB over the
same Parquet files, and compare row count, column names and the multiset of
rows (floats rounded). Usage: python tests/oracle_compare.py [sf_dir] [names...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.sources.tables import TABLES  # noqa: E402



def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def spark_family(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int", "bigint") or t.startswith("decimal(") and t.endswith(",0)"):
        return "int"
    if t in ("float", "double"):
        return "float"
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("timestamp"):
        return "timestamp"
    return {"string": "string", "boolean": "bool", "date": "date"}.get(t, t.split("<")[0])


def duck_family(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    return {"VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date"}.get(t, t.lower())


SPARK_TO_DUCK = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
                 "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def exact_type(t: str) -> str:
    """The DuckDB type name a Spark type corresponds to exactly."""
    if t.startswith("decimal"):
        return t.upper()
    if t.startswith("array<"):
        return exact_type(t[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(t, t.upper())


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="no oracle")
    rel = con.sql(sql)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    st = dict(sdf.dtypes)
    tmis = {c: (st[c], dtypes[c]) for c in st if c in dtypes and exact_type(st[c]) != dtypes[c].upper()}
    if tmis:
        res["type_mismatch"] = tmis
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, note=f"columns differ: spark={sorted(scols)} oracle={sorted(dcols)}")
        return res
    a, b = Counter(rows_of(scols, srows)), Counter(rows_of(dcols, drows))
    if a == b:
        res.update(ok=True)
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        res.update(ok=False, note=f"values differ; spark-only={only_s} oracle-only={only_d}")
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tessera.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", 8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        try:
            r = compare(spark, sf_dir, n, qs[n], orc.get(n), con)
        except Exception as e:  # report and continue
            r = dict(name=n, ok=False, note=f"error: {type(e).__name__}: {str(e)[:600]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
