"""Run registered queries and their SQL side by side.

    python tests/oracle_compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if value is None or isinstance(value, (bool, int, str)):
        return repr(value)
    return repr(float(value)) if hasattr(value, "as_tuple") else repr(value)


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, function, sql, sf_dir) -> tuple[bool, str]:
    started = time.time()
    frame = function(spark, sf_dir)
    rows = [tuple(r) for r in frame.collect()]
    took = time.time() - started
    if sql is None:
        return True, f"{took:6.1f}s rows={len(rows)} (no SQL)"
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}"
    mine, theirs = as_set(frame.columns, rows), as_set(names, expected)
    if mine != theirs:
        gone = [t for t in theirs if t not in set(mine)][:2]
        new = [t for t in mine if t not in set(theirs)][:2]
        return False, f"rows {len(mine)} vs {len(theirs)}\n   sql only:   {gone}\n   spark only: {new}\n   {sorted(names)}"
    return True, f"{took:6.1f}s rows={len(rows)}"


def main() -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--skip-models", action="store_true")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark, con = make_session(), connect(options.sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    unknown = set(sql) - set(queries)
    failed = [f"unknown SQL {unknown}"] if unknown else []
    for name, function in queries.items():
        if options.names and name not in options.names:
            continue
        if options.skip_models and sql.get(name) is None:
            continue
        try:
            good, text = compare(spark, con, name, function, sql.get(name), options.sf)
        except Exception as error:  # noqa: BLE001
            good, text = False, "".join(traceback.format_exception(error))[-1500:]
        print(("ok   " if good else "FAIL ") + name, text, flush=True)
        if not good:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
