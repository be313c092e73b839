"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    if hasattr(v, "as_tuple"):
        return float(v)
    return str(v)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()]), sorted(df.columns)


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return canonical(cols, cur.fetchall()), sorted(cols)


def differences(got, want, cols, limit: int = 3) -> str:
    if len(got) != len(want):
        return f"row counts {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if not bad:
        return ""
    per_col: dict[str, int] = {}
    for g, w in bad:
        for c, a, b in zip(cols, g, w):
            if a != b:
                per_col[c] = per_col.get(c, 0) + 1
    show = [[(c, a, b) for c, a, b in zip(cols, g, w) if a != b][:4] for g, w in bad[:limit]]
    return f"{len(bad)} rows differ; {dict(list(per_col.items())[:8])}; {show}"
