"""Compare registered queries with their SQL on one data folder.

    python tools/check_oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import shutil
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderloom.catalogue import registered  # noqa: E402
from orderloom.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return str(value) if isinstance(value, (list, dict)) else value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kind(name: str) -> str:
    """A type as both engines would call it."""
    name = name.lower()
    pairs = {
        "varchar": "string", "integer": "int", "timestamp": "timestamp_ntz", "bool": "boolean",
    }
    return pairs.get(name, name)


def check(spark, con, q, sf_dir) -> tuple[str, float, int]:
    start = time.time()
    df = q(spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if not q.sql:
        return "no sql", took, len(rows)
    cursor = con.execute(q.sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(names)}", took, len(rows)
    types = {r[0]: kind(r[1]) for r in con.execute(f"DESCRIBE {q.sql}").fetchall()}
    other = {n: (t, types[n]) for n, t in df.dtypes if kind(t) != types[n]}
    got, want = bag(df.columns, rows), bag(names, expected)
    if got != want:
        missing, extra = list((want - got).items())[:2], list((got - want).items())[:2]
        return f"VALUES {len(rows)} vs {len(expected)}\n    want {missing}\n    got  {extra}", took, len(rows)
    return (f"ok, types differ {other}" if other else "ok"), took, len(rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    shared = tempfile.mkdtemp(prefix="orderloom-check-")  # one machine: its disk is what all executors share
    spark = build_session(
        spark__checkpoint__dir=f"{shared}/work", spark__sql__warehouse__dir=f"{shared}/warehouse",
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, q in registered().items():
        if args.names and name not in args.names:
            continue
        try:
            verdict, took, n = check(spark, con, q, args.sf)
        except Exception as err:  # noqa: BLE001
            verdict, took, n = f"ERROR {type(err).__name__}: {str(err)[:600]}", 0.0, 0
        bad += not verdict.startswith(("ok", "no sql"))
        print(f"{name:32s} {took:6.2f}s {n:7d}  {verdict}", flush=True)
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
