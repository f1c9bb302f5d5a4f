"""Query registry and the shared SQL fragments of the equivalent texts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


def fragment(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql


def _with(sql: str) -> str:
    """Put the fragments a text mentions in front of it, in dependency order."""
    order: list[str] = []

    def visit(text: str, inside: tuple[str, ...]) -> None:
        for name in FRAGMENTS:
            if name not in order and name not in inside and re.search(rf"\b{name}\b", text):
                visit(FRAGMENTS[name], (*inside, name))
                order.append(name)

    visit(sql, ())
    ctes = ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{sql}" if ctes else sql


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = _with(sql)
        return fn

    return register


def r6(col: Column | str, name: str, digits: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), digits).alias(name)


def as_long(df: DataFrame, *names: str) -> DataFrame:
    for n in names:
        df = df.withColumn(n, F.col(n).cast("long"))
    return df


fragment("v_ev", """
  SELECT event_type AS chrom, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) - 1704067200 AS start,
         round((value - 50) / 25, 3) AS score, CAST(user_id % 241 AS INTEGER) AS depth FROM events""")
fragment("v_sites", """
  SELECT chrom, start, start + 1 AS "end", max(score) AS score FROM v_ev GROUP BY chrom, start""")
fragment("v_chromes", "SELECT chrom, max(start) + 1 AS length FROM v_ev GROUP BY chrom")
fragment("v_depth", """
  SELECT chrom, start, start + 1 AS "end", max(depth) AS depth FROM v_ev GROUP BY chrom, start""")
fragment("v_scored", """
  SELECT *, CASE WHEN score > 0 THEN 0 WHEN score < 0 THEN 2 ELSE 1 END AS status,
         pow(10.0, -abs(score)) AS p FROM v_sites""")
fragment("v_bh", """
  SELECT chrom, start, "end", score, status, p, least(1.0, qmin) AS p_adj,
         CASE WHEN least(1.0, qmin) < 0.05 THEN 1 ELSE 0 END AS sig
  FROM (SELECT *, min(q) OVER (ORDER BY p DESC) AS qmin
        FROM (SELECT *, count(*) OVER () / count(*) OVER (ORDER BY p) * p AS q FROM v_scored))""")
fragment("v_bh_chrom", """
  SELECT chrom, start, "end", score, status, p, least(1.0, qmin) AS p_adj,
         CASE WHEN least(1.0, qmin) < 0.05 THEN 1 ELSE 0 END AS sig
  FROM (SELECT *, min(q) OVER (PARTITION BY chrom ORDER BY p DESC) AS qmin
        FROM (SELECT *, count(*) OVER (PARTITION BY chrom) / count(*) OVER (PARTITION BY chrom ORDER BY p) * p AS q
              FROM v_scored))""")
fragment("v_cons", """
  SELECT chrom, start, "end", CAST(status AS VARCHAR) || CAST(sig AS VARCHAR) AS sig_code
  FROM v_bh WHERE status = 0 AND sig = 1""")
fragment("v_win", """
  SELECT chrom, w * 21600 AS start, least(w * 21600 + 21600, length) AS "end", w AS window_no
  FROM v_chromes, LATERAL (SELECT unnest(range(0, (length + 21599) // 21600)) AS w)""")
fragment("v_wincount", """
  SELECT v.chrom, v.start, v."end", v.window_no, coalesce(c.n, 0) AS n
  FROM v_win v LEFT JOIN (SELECT chrom, start // 21600 AS window_no, count(*) AS n FROM v_cons GROUP BY ALL) c
  ON v.chrom = c.chrom AND v.window_no = c.window_no""")
fragment("v_iv", """
  SELECT l_returnflag AS chrom, l_orderkey * 10 + l_linenumber AS start,
         l_orderkey * 10 + l_linenumber + CAST(l_quantity AS BIGINT) AS "end", l_partkey AS part FROM lineitem""")
fragment("v_probe", """
  SELECT CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'R' END AS chrom, o_orderkey * 10 AS start,
         o_orderkey * 10 + 5 + o_custkey % 20 AS "end", o_custkey AS cust FROM orders""")


def merged_sql(source: str, gap: int, keys: str = "chrom") -> str:
    """Gaps-and-islands text for interval merging."""
    return f"""
      SELECT {keys}, min(start) AS start, max("end") AS "end", count(*) AS n_merged
      FROM (SELECT *, sum(CASE WHEN reach IS NULL OR start - reach > {gap} THEN 1 ELSE 0 END)
                      OVER (PARTITION BY {keys} ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS isl
            FROM (SELECT *, max("end") OVER (PARTITION BY {keys} ORDER BY start, "end"
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
                  FROM ({source})))
      GROUP BY {keys}, isl"""
