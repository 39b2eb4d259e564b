"""Compare a query with its DuckDB SQL: column names, types' kinds, and rows without regard to order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.sql(f"create view {t} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        v = float(v)
        return None if math.isnan(v) else v + 0.0
    return str(v)


def _order(row: tuple) -> str:
    return repr([round(v, 4) if isinstance(v, float) else v for v in row])


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=_order)


def _same(p: tuple, q: tuple) -> bool:
    """Equal, numbers to a millionth of themselves."""
    return all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9) if type(a) is type(b) is float else a == b for a, b in zip(p, q))


def differences(spark, sf_dir: str, query, sql: str) -> str:
    got = query(spark, sf_dir)
    a_cols, a = got.columns, [tuple(r) for r in got.collect()]
    rel = duck(sf_dir).sql(sql)
    b_cols, b = rel.columns, rel.fetchall()
    if sorted(a_cols) != sorted(b_cols):
        return f"columns {sorted(a_cols)} and {sorted(b_cols)}"
    x, y = rows(a_cols, a), rows(b_cols, b)
    if len(x) != len(y):
        return f"{len(x)} and {len(y)} rows"
    odd = [(p, q) for p, q in zip(x, y) if not _same(p, q)]
    return f"{len(odd)} of {len(x)} rows differ, as {odd[:2]}" if odd else ""
