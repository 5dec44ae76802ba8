"""Compare registered queries with their SQL: ``python tests/check.py [sf] [key ...]``.

HOT_ROWS in the environment lowers the hot-group limit, so that small tables take
the sliced plans; EXACT compares doubles to the last bit.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.plans.ordered import HOT_ROWS_CONF  # noqa: E402
from millrace.registry import all_queries  # noqa: E402
from millrace.session import local_session  # noqa: E402
from millrace.sources.tables import TABLES  # noqa: E402

TESTDATA = "/root/testdata"
EXACT = bool(os.environ.get("EXACT"))


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value if EXACT else float(f"{value:.9g}")
    return value


def _kind(value):
    return type(value).__name__


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, q, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = q(spark, sf_dir)
    bad = {x for _, x in df.dtypes} - {"bigint", "double", "string"}
    mine = [tuple(r) for r in df.collect()]
    if bad:
        return f"output types {bad}"
    if q.oracle is None:
        return None if mine else "no rows"
    cursor = con.execute(q.oracle)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, mine), rows_of(names, theirs)
    if len(a) != len(b):
        extra = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return f"rows {len(a)} vs {len(b)}: {extra}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} vs {y}"
        if [_kind(v) for v in x] != [_kind(v) for v in y]:
            return f"types {x} vs {y}"
    return None if a else "EMPTY"


def main(argv):
    sf = argv[0] if argv else "0.01"
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT_ROWS"):
        spark.conf.set(HOT_ROWS_CONF, os.environ["HOT_ROWS"])
    sf_dir = f"{TESTDATA}/sf{sf}"
    con = connect(sf_dir)
    queries = all_queries()
    wanted = argv[1:] or list(queries)
    wanted = [k for k in queries if any(k == w or (w.endswith("*") and k.startswith(w[:-1])) for w in wanted)]
    failed = []
    for key in wanted:
        started = time.time()
        try:
            problem = compare(spark, con, queries[key], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        took = time.time() - started
        if problem:
            failed.append(key)
            print(f"FAIL {key} {took:.1f}s {problem}", flush=True)
        elif took > 3:
            print(f"slow {key} {took:.1f}s", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} equal; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
