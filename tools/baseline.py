"""Markdown rows of bench.py's JSON (stdin) next to DuckDB's seconds for the same SQL."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from millrace.plans import oracle_sql  # noqa: E402
from millrace.tables import SCHEMAS  # noqa: E402


def main() -> None:
    bench = json.load(sys.stdin)
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    con = duckdb.connect(config={"threads": int(os.environ.get("BENCH_CPUS", "8"))})
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    for name, warm in bench["queries"].items():
        times = []
        for _ in range(3):
            start = time.perf_counter()
            con.execute(f"create or replace temp table result as {oracle_sql()[name]}")
            times.append(time.perf_counter() - start)
        rows = con.execute("select count(*) from result").fetchone()[0]
        print(f"| {name} | {bench['cold'][name]:.2f} | {warm:.2f} | {statistics.median(times):.2f} | {rows:,} |")


if __name__ == "__main__":
    main()
