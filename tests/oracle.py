"""Run registered queries beside their SQL text in DuckDB and compare whole results."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"memory_limit": "8GB"})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if abs(v) >= 1e5 else f"{v:.9f}"
    return "null" if v is None else repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """(ok, message, seconds) for one query."""
    t = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - t
    if sql is None:
        return True, f"rows only: {len(got)}", took
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}", took
    a, b = _rows(df.columns, [tuple(r) for r in got]), _rows(names, want)
    if a != b:
        only_a, only_b = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
        return False, f"{len(a)} vs {len(b)} rows; spark {only_a}; sql {only_b}", took
    return True, f"{len(a)} rows", took
