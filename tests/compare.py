"""Both sides of a query's check: its rows in Spark and in DuckDB, as sorted text."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(v):
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return "∅" if v is None else str(v)


def rows(columns: list[str], data) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted(tuple(plain(r[k]) for k in order) for r in data)


def both(spark, sf_dir: str, query, sql: str):
    df = query(spark, sf_dir)
    rel = duck(sf_dir).sql(sql)
    return rows(df.columns, [tuple(r) for r in df.collect()]), rows(rel.columns, rel.fetchall())
