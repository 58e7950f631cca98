"""Compare a query's rows with those of its SQL, whatever their order."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value if value is None or isinstance(value, (int, bool)) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    names, expected = rows_of([d[0] for d in found.description], found.fetchall())
    ours, actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert ours == names
    assert len(actual) == len(expected)
    for a, e in zip(actual, expected, strict=True):
        assert a == e
