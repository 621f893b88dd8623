"""Run queries against their SQL: python -m workloads.compare SF_DIR [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

from regiofact.session import local_session
from workloads import load_all
from workloads.base import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), [tuple(r[i] for i in order) for r in cur.fetchall()]


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]


def _text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value:.4f}" if value else "0.0000"
    return str(value)


def difference(left: list[tuple], right: list[tuple]) -> str | None:
    """None if both hold the same rows, else a short description."""
    a = sorted(tuple(map(_text, r)) for r in left)
    b = sorted(tuple(map(_text, r)) for r in right)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows and {len(b)} rows; only in query {only_a}; only in SQL {only_b}"


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    load_all()
    spark = local_session(8)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
            took = time.time() - start
            if name not in ORACLES:
                print(f"rows {name} {len(rows)} {took:.1f}s", flush=True)
                continue
            expected_columns, expected = oracle_rows(sf_dir, ORACLES[name])
            problem = (
                f"columns {columns} and {expected_columns}"
                if columns != expected_columns
                else difference(rows, expected)
            )
            if not rows:
                problem = problem or "no rows"
        except Exception as e:
            took, problem = time.time() - start, "".join(traceback.format_exception_only(e))[:1500]
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'} {name} {len(rows) if not problem else ''} {took:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}")
    return failed


if __name__ == "__main__":
    sys.exit(main() != 0)
