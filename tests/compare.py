"""Runs registered queries beside their SQL twins in DuckDB and reports differences.

    python tests/compare.py [--sf 0.01] [key-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def sort_key(row):
    return tuple((v is None, "" if v is None else (f"{v:.6e}" if isinstance(v, float) else str(v))) for v in row)


def differences(spark_df, con, text: str) -> list[str]:
    """Empty when column names, types and rows agree."""
    rel = con.sql(text)
    spark_types = dict(spark_df.dtypes)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    out = []
    if sorted(spark_types) != sorted(duck_types):
        return [f"columns {sorted(spark_types)} != {sorted(duck_types)}"]
    for name, kind in spark_types.items():
        if TYPES.get(kind) != duck_types[name]:
            out.append(f"type of {name}: {kind} != {duck_types[name]}")
    names = sorted(spark_types)
    left = sorted((tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()), key=sort_key)
    quoted = ", ".join('"%s"' % n for n in names)
    right = sorted(con.sql(f"SELECT {quoted} FROM ({text})").fetchall(), key=sort_key)
    if len(left) != len(right):
        out.append(f"rows {len(left)} != {len(right)}")
    if not right:
        out.append("no rows")
    inexact = 0
    for a, b in zip(left, right):
        if a != b:
            bad = [
                n for n, x, y in zip(names, a, b)
                if x != y and not (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-12))
            ]
            if bad:
                out.append(f"{bad}: {dict(zip(names, a))} != {dict(zip(names, b))}")
                break
            inexact += 1
    if inexact:
        out.append(f"{inexact} rows differ in the last digits")
    return out


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("keys", nargs="*")
    args = p.parse_args()
    folder = f"/root/testdata/sf{args.sf}"

    import __spark_entry__ as entry
    from tradewake.session import build_session

    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for key, fn in queries.items():
        if args.keys and not any(key.startswith(k) for k in args.keys):
            continue
        began = time.time()
        try:
            df = fn(spark, folder)
            if key in oracles:
                problems = differences(df, con, oracles[key])
                n = ""
            else:
                problems, n = [], f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problems, n = [str(e)[:1500]], ""
            if not str(e):
                traceback.print_exc()
        print(f"{'FAIL' if problems else 'ok  '} {key} {time.time() - began:.1f}s {n} {'; '.join(problems)}", flush=True)
        if problems:
            failed.append(key)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
