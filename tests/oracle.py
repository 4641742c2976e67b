"""A Spark result against the rows that DuckDB gives for the same tables."""

from __future__ import annotations

import glob
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path if os.path.isfile(path) else glob.escape(path) + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, sql: str, sf_dir: str = SF) -> None:
    found = connect(sf_dir).execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(df.columns)
    want = sorted(repr([plain(r[names.index(c)]) for c in order]) for r in found.fetchall())
    got = sorted(repr([plain(r[c]) for c in order]) for r in df.collect())
    assert got == want
