"""Comparison of a query with its SQL."""

import math
import os

import duckdb


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(_plain, v)) if isinstance(v, list) else v


def views(sf):
    c = duckdb.connect()
    for t in os.listdir(sf):
        c.sql(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    return c


def same(df, rel):
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
