"""Side-by-side check of a registered query against its DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float | decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, list | tuple):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in v.items()) + "}"
    if hasattr(v, "asDict"):
        return canon(v.asDict())
    return str(v)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries

    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    con = con or duck(sf_dir)
    rel = con.sql(oracle_sql()[name])
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    a = sorted("|".join(canon(r[i]) for i in si) for r in s_rows)
    b = sorted("|".join(canon(r[i]) for i in di) for r in d_rows)
    if len(a) != len(b):
        return False, f"rows differ: spark={len(a)} duck={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diff}"
    return True, f"{len(a)} rows"
