"""Run queries and their SQL twins side by side: python tools/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acreline.queries import ORACLES, QUERIES  # noqa: E402
from acreline.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    return "NULL" if value is None else str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, name):
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    seconds = time.time() - start
    if name not in ORACLES:
        return f"rows-only {len(rows)}", seconds
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    left, right = canonical(df.columns, rows), canonical(names, cur.fetchall())
    if left == right:
        return f"ok {len(rows)}", seconds
    if left[0] != right[0]:
        return f"COLUMNS {left[0]} / {right[0]}", seconds
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b][:3]
    return f"MISMATCH {len(left[1])}/{len(right[1])} {bad} {types} {df.dtypes}", seconds


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    good = 0
    for name in names:
        try:
            text, seconds = compare(spark, con, sf_dir, name)
        except Exception as problem:
            text, seconds = f"FAILED {type(problem).__name__}: {str(problem)[:600]}", 0.0
        good += text.startswith(("ok", "rows-only"))
        print(f"{seconds:7.2f}s {name:28s} {text}", flush=True)
    print(f"{good}/{len(names)} fine")


if __name__ == "__main__":
    main(sys.argv[1:])
