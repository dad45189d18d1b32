"""Run a query and its SQL side by side and compare rows as multisets."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def database(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, query, sql, sf_dir, connection):
    """Empty when both give the same columns and rows; otherwise what differs."""
    frame = query(spark, sf_dir)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return {"columns": (sorted(names), sorted(frame.columns))}, 0
    got = multiset(frame.columns, [tuple(row) for row in frame.collect()])
    want = multiset(names, result.fetchall())
    if got == want:
        return {}, sum(got.values())
    return {
        "columns": sorted(names),
        "rows": (sum(got.values()), sum(want.values())),
        "extra": list((got - want).items())[:3],
        "missing": list((want - got).items())[:3],
    }, sum(got.values())
