"""Run registered queries against their SQL oracle and compare whole results.

    python tests/compare.py [sf dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, float):
        return repr(0.0 if value == 0 else value)
    if hasattr(value, "isoformat"):
        return str(value)
    return repr(value) if not isinstance(value, bool) else str(bool(value))


def canonical_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def _close(a: str, b: str) -> bool:
    try:
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1.1e-6)
    except ValueError:
        return a == b


def compare(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when the results are equal, else what differs."""
    df = query(spark, sf_dir)
    got = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = canonical_rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first got {got[:1]} want {want[:1]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not bad:
        return ""
    near = sum(all(_close(a, b) for a, b in zip(g, w)) for g, w in bad)
    return f"{len(bad)} of {len(got)} rows differ ({near} by rounding): {bad[0]}"


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from pulsetrail.session import build_session

    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failures = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.perf_counter()
        try:
            if name in sqls:
                problem = compare(spark, con, query, sqls[name], sf_dir)
                verdict = "ok" if not problem else "DIFF " + problem
            else:
                verdict = f"rows {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            verdict = "FAIL " + " ".join(str(error).split())[:300]
        failures += verdict.startswith(("DIFF", "FAIL"))
        print(f"{name:22s} {time.perf_counter() - started:6.2f}s {verdict}", flush=True)
    return failures


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(args[0], args[1:]))
