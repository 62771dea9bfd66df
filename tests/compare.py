"""Compare every catalog query with its SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "customer orders lineitem events labels".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    got = entry.queries()[name](spark, sf_dir)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    mine, theirs = rows_of(got.columns, got.collect()), rows_of(columns, want.fetchall())
    if mine == theirs:
        return None
    extra = [r for r in mine if r not in set(theirs)][:2]
    missing = [r for r in theirs if r not in set(mine)][:2]
    return f"{len(mine)} rows vs {len(theirs)}; only here {extra}; only there {missing}"


if __name__ == "__main__":
    from riskloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            if name in entry.oracle_sql():
                result = difference(spark, con, sf_dir, name) or "ok"
            else:
                result = f"rows only: {len(entry.queries()[name](spark, sf_dir).collect())}"
        except Exception as error:  # report and go on
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {result}", flush=True)
