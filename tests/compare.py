"""Run registered queries against their SQL twins: ``python tests/compare.py DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(v)
    return "null" if v is None else str(v)


def _rows(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, name: str, query, sql: str | None, sf_dir: str) -> str:
    """Empty when Spark and SQL agree in names, rows and values."""
    start = time.time()
    df = query(spark, sf_dir)
    got, names = df.collect(), df.columns
    took = time.time() - start
    print(f"{name}: {len(got)} rows {took:.1f}s", end=" ", flush=True)
    if sql is None:
        return ""
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want = cur.fetchall()
    print(f"sql {time.time() - start - took:.1f}s", end=" ", flush=True)
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    a, b = _rows(got, names), _rows(want, want_names)
    if a == b:
        return ""
    left, right = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return (f"{len(a)} rows against {len(b)}; {len(left)} only Spark, {len(right)} only SQL "
            f"{sorted(names)}\n   spark {left[:2]}\n   sql   {right[:2]}")


def main() -> None:
    import __spark_entry__ as entry
    from perfspark.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = []
    for name in wanted or queries:
        try:
            text = difference(spark, con, name, queries[name], sqls.get(name), sf_dir)
        except Exception as e:  # keep going: list all failures
            text = f"{type(e).__name__}: {str(e)[:1500]}"
        print("ok" if not text else f"FAIL {text}", "" if name in sqls else "(rows only)", flush=True)
        if text:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
