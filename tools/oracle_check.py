"""Local correctness check: Spark query vs DuckDB oracle SQL.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [names...]

Compares row count, column names and types, and an order-insensitive
hash of the rows (doubles rounded to 6 places; ORACLE_STRICT=1 compares exact
float representations).  Prints one line per query.
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from basketry.plans.registry import all_queries  # noqa: E402
from basketry.plans.session import local_session  # noqa: E402

_TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
          "DateType": "DATE", "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "ShortType": "SMALLINT",
          "TimestampType": "TIMESTAMP", "TimestampNTZType": "TIMESTAMP"}


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session()
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs = all_queries()
    names = a.names or sorted(qs)
    bad = 0
    for name in names:
        q = qs[name]
        t0 = time.time()
        try:
            df = q.fn(spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [_TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields]
        except Exception as exc:  # noqa: BLE001
            print(f"ERR   {name}: spark failed: {str(exc)[:600]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"ROWS  {name}: {len(srows)} rows (no oracle) {ts:.2f}s")
            continue
        try:
            rel = con.sql(q.sql)
            drows = rel.fetchall()
            dcols = rel.columns
            dtypes = [str(t) for t in rel.types]
        except Exception as exc:  # noqa: BLE001
            print(f"ERR   {name}: duckdb failed: {str(exc)[:600]}")
            bad += 1
            continue
        problems = []
        if sorted(scols) != sorted(dcols):
            problems.append(f"cols spark={scols} duck={dcols}")
        else:
            st = dict(zip(scols, stypes))
            dtt = dict(zip(dcols, dtypes))
            tdiff = {c: (st[c], dtt[c]) for c in scols if st[c] != dtt[c]}
            if tdiff:
                problems.append(f"types {tdiff}")
        if len(srows) != len(drows):
            problems.append(f"rows spark={len(srows)} duck={len(drows)}")
        if not problems or all(p.startswith("types") for p in problems):
            hs, ls = digest(scols, srows)
            hd, ld = digest(dcols, drows)
            if hs != hd:
                only_s = [x for x in ls if x not in set(ld)][:3]
                only_d = [x for x in ld if x not in set(ls)][:3]
                problems.append(f"hash spark-only={only_s} duck-only={only_d}")
        if problems:
            bad += 1
            print(f"FAIL  {name}: " + "; ".join(problems)[:1500])
        else:
            print(f"OK    {name}: {len(srows)} rows {ts:.2f}s")
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
