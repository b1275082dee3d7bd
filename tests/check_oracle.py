"""Run registered queries and their SQL side by side: python tests/check_oracle.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from minewright.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr), [columns[i] for i in order]


def compare(spark, connection, name, sf_dir):
    start = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    got, got_columns = rows_of(frame.columns, frame.collect())
    seconds = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return seconds, "rows", f"{len(got)} rows"
    cursor = connection.execute(sql)
    wanted, wanted_columns = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_columns != wanted_columns:
        return seconds, "DIFF", f"columns {got_columns} != {wanted_columns}"
    if got != wanted:
        extra, missing = sorted(set(got) - set(wanted), key=repr)[:2], sorted(set(wanted) - set(got), key=repr)[:2]
        return seconds, "DIFF", f"{len(got)} != {len(wanted)} rows; only here {extra}; only there {missing}"
    return seconds, "ok", f"{len(got)} rows"


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, connection = local_session(8), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            seconds, state, note = compare(spark, connection, name, sf_dir)
        except Exception as error:
            seconds, state, note = 0.0, "ERROR", f"{type(error).__name__}: {str(error)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += state in {"DIFF", "ERROR"}
        print(f"{name:24s} {state:6s} {seconds:7.2f}s {note}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
