"""Compare a query with its SQL over the same tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else a short description."""
    have_columns, have = bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want_columns, want = bag([d[0] for d in cursor.description], cursor.fetchall())
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    if have != want:
        more, less = have - want, want - have
        return (
            f"{sum(have.values())} rows vs {sum(want.values())}; only here "
            f"{list(more.items())[:3]}; only in SQL {list(less.items())[:3]}"
        )
    return None if have else "no rows"
