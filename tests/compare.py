"""Run registered queries next to their SQL counterparts and compare the rows.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from folioworks.queries import ORACLES, QUERIES
from folioworks.queries.registry import TABLES
from folioworks.session import build_session


def data_dir(sf: str) -> str:
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), f"sf{sf}")


def oracle_rows(sql: str, folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted([tuple(repr(row[i]) for i in order) for row in rows])


def compare(spark, name: str, folder: str) -> str | None:
    """None if the rows agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        return None if got else "no rows"
    want_names, want = normal(*oracle_rows(ORACLES[name], folder))
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if not want:
        return "the counterpart gives no rows"
    if got != want:
        extra, lack = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows != {len(want)}; extra {sorted(extra)[:3]}; lacking {sorted(lack)[:3]}"
    return None


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in opts.names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, name, data_dir(opts.sf))
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
