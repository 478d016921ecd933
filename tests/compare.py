"""Run registered queries next to their SQL on one scale factor and compare the results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events labels".split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (0, "") if math.isnan(v) else (1, f"{v + 0.0:.6g}" if v else "0")
    if isinstance(v, bool):
        return (2, str(v))
    return (2, str(v))


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(set(df.columns) ^ set(names))}"
    types = [
        f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]
    ]
    a, b = normal_rows(df.columns, rows), normal_rows(names, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} of {len(a)} rows differ; first {bad[0]}"
    if types:
        return False, f"types {types}"
    return True, f"{len(a)} rows, {took:.1f}s"


def main() -> None:
    import workload.learn_queries  # noqa: F401
    from workload.oracle import ORACLE
    from workload.queries import QUERIES
    from tests.conftest import make_session

    only = [a for a in sys.argv[1:] if not a.startswith("sf")]
    sf = next((a for a in sys.argv[1:] if a.startswith("sf")), "sf0.01")
    sf_dir = f"{DATA}/{sf}"
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            if name in ORACLE:
                ok, note = compare(spark, con, name, fn, ORACLE[name], sf_dir)
            else:
                start = time.time()
                n = len(fn(spark, sf_dir).collect())
                ok, note = n > 0, f"rows only: {n} rows, {time.time() - start:.1f}s"
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
