"""Runs a query and its SQL on the same tables and compares the rows, columns by name."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((x is None, round(x, 4) if isinstance(x, float) and math.isfinite(x) else x if not isinstance(x, bool) else int(x)) if x is not None else (True, 0) for x in row)


def difference(con, df, sql: str) -> str:
    """Empty if both have the same columns and rows."""
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    cols = sorted(names)
    theirs = sorted((tuple(r[names.index(c)] for c in cols) for r in rel.fetchall()), key=lambda r: str(_key(r)))
    ours = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: str(_key(r)))
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if not all(x == y or isinstance(x, float) and isinstance(y, (float, int)) and math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-9) for x, y in zip(a, b, strict=True))]
    return f"{len(bad)} of {len(ours)} rows differ, as {bad[0]}" if bad else ""
