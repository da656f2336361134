"""Run a registered query and its reference SQL and compare the rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Types that stand for each other in the two engines.
_SAME = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def compare(frame, sql, connection):
    """None if equal, else a short description."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns differ: {sorted(frame.columns)} / {sorted(names)}"
    expected_types = {d[0]: _SAME.get(str(d[1]), str(d[1])) for d in result.description}
    if expected_types != dict(frame.dtypes):
        return f"types differ: {sorted(set(frame.dtypes) ^ set(expected_types.items()))}"
    got = [tuple(r) for r in frame.collect()]
    left, right = bag(frame.columns, got), bag(names, expected)
    if left != right:
        return f"{len(got)}/{len(expected)} rows; extra {list((left - right).items())[:2]}; missing {list((right - left).items())[:2]}"
    return None
