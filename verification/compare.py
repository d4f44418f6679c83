"""Run queries beside their SQL and compare whole results."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[int, str]:
    """Row count, and what differs ('' when the results are equal)."""
    df = query(spark, sf_dir)
    got = _bag(df.columns, df.collect())
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    want = _bag(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return sum(got.values()), f"columns {sorted(df.columns)} against {sorted(names)}"
    if got != want:
        extra, lost = list((got - want).items())[:3], list((want - got).items())[:3]
        return sum(got.values()), f"only here {extra}; only in SQL {lost}"
    return sum(got.values()), ""
