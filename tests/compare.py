"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    extra = sorted(set(got) - set(expected))[:3]
    missing = sorted(set(expected) - set(got))[:3]
    return f"{len(got)} rows against {len(expected)}; extra {extra}; missing {missing}"
