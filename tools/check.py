"""Compare registered queries with their SQL in DuckDB: python tools/check.py [-d DIR] [name ...]."""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from millrace.plans import oracle_sql, queries  # noqa: E402
from millrace.tables import SCHEMAS  # noqa: E402
from tests.support import local_session  # noqa: E402


def norm(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)) or type(value).__name__ in ("Decimal",):
        return ("n", float(value))
    return ("s", str(value))


def close(a, b) -> bool:
    if a == b:
        return True
    if a and b and a[0] == b[0] == "n":
        return abs(a[1] - b[1]) <= 1e-9 * max(abs(a[1]), abs(b[1]), 1e-6)
    return False


def key(row):
    return [(v is None, "" if v is None else v[0], 0 if v is None else (round(v[1], 6) if v[0] == "n" else v[1])) for v in row]


def compare(cols, rows, dcols, drows) -> str:
    if sorted(cols) != sorted(dcols):
        return f"COLUMNS {sorted(cols)} vs {sorted(dcols)}"
    if len(rows) != len(drows):
        return f"ROWS {len(rows)} vs {len(drows)}"
    order, dorder = sorted(range(len(cols)), key=lambda i: cols[i]), sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted(([norm(r[i]) for i in order] for r in rows), key=key)
    b = sorted(([norm(r[i]) for i in dorder] for r in drows), key=key)
    inexact = 0
    for x, y in zip(a, b):
        for v, w in zip(x, y):
            if v != w:
                if not close(v, w):
                    return f"VALUES {x} vs {y}"
                inexact += 1
    return "ok" if not inexact else f"ok but {inexact} floats differ in the last bits"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("-d", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session()
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from '{args.d}/{table}.parquet'")
    built, sqls, bad = queries(), oracle_sql(), 0
    wanted = [n for n in built if not args.names or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    for name in wanted:
        start = time.time()
        try:
            df = built[name](spark, args.d)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in sqls:
                verdict = f"no sql, {len(rows)} rows"
            else:
                res = con.execute(sqls[name])
                verdict = compare(df.columns, rows, [d[0] for d in res.description], res.fetchall())
                kinds = [f"{d[0]}:{d[1]}" for d in res.description if str(d[1]) in ("HUGEINT",) or "DECIMAL" in str(d[1])]
                verdict += f" TYPES {kinds}" if kinds else ""
        except Exception as error:  # noqa: BLE001
            took = time.time() - start
            verdict = "ERROR " + "".join(traceback.format_exception_only(error))[:1500]
        if not verdict.startswith(("ok", "no sql")):
            bad += 1
        print(f"{name:28s} {took:6.2f}s {verdict} ({len(rows) if 'rows' in dir() else '?'})", flush=True)
    print(f"{len(wanted)} queries, {bad} bad")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
