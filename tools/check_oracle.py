"""Run registered queries on Spark and their oracle SQL on DuckDB, and compare.

Mirrors the driver's check: row count, column names, order-insensitive values.
Usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.session import local_session  # noqa: E402
from tessera.sources.tables import BASE_TABLES  # noqa: E402
from tessera.workloads import load_all  # noqa: E402


SPARK_T = {"long": "bigint", "integer": "int", "double": "double", "string": "string", "boolean": "boolean",
           "date": "date", "timestamp_ntz": "timestamp", "float": "float", "decimal": "decimal", "array": "array"}
DUCK_T = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
          "DATE": "date", "TIMESTAMP": "timestamp", "FLOAT": "float", "DECIMAL": "decimal", "HUGEINT": "hugeint"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    reg = load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = rows_only = 0
    for key, q in reg.items():
        if keys and key not in keys:
            continue
        t0 = time.time()
        try:
            df = q.run(spark, sf_dir)
            s_cols = df.columns
            s_types = {f.name: SPARK_T.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema.fields}
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        dt = time.time() - t0
        if q.sql is None:
            rows_only += 1
            print(f"rows {key}: {len(s_rows)} rows ({dt:.1f}s)")
            continue
        try:
            res = con.execute(q.sql)
            d_cols = [c[0] for c in res.description]
            d_types = {c[0]: DUCK_T.get(str(c[1]).split("(")[0], str(c[1])) for c in res.description}
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {key}: duckdb error {str(e)[:400]}")
            continue
        msgs = []
        if sorted(s_cols) != sorted(d_cols):
            msgs.append(f"cols spark={s_cols} duck={d_cols}")
        tdiff = {c: (s_types.get(c), d_types.get(c)) for c in s_types if s_types.get(c) != d_types.get(c)}
        if tdiff:
            msgs.append(f"types {tdiff}")
        if len(s_rows) != len(d_rows):
            msgs.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
        if not msgs:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                msgs.append(f"values differ e.g. {diff}")
        if msgs:
            bad += 1
            print(f"FAIL {key}: " + "; ".join(msgs))
        else:
            ok += 1
            print(f"ok   {key}: {len(s_rows)} rows ({dt:.1f}s)")
    print(f"summary: ok={ok} fail={bad} rows_only={rows_only}")


if __name__ == "__main__":
    try:
        main()
    except Exception:
        traceback.print_exc()
        sys.exit(1)
