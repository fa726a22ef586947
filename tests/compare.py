"""Comparison of a Spark result with the rows of its SQL oracle."""

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages"
          " benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def difference(df, con, sql):
    """None if equal, otherwise a short account of the difference."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return f"columns {names} <> {sorted(relation.columns)}"
    left = Counter(tuple(map(_value, row)) for row in df.select(*names).collect())
    columns = ", ".join(f'"{n}"' for n in names)
    right = Counter(tuple(map(_value, row)) for row in relation.project(columns).fetchall())
    if left == right:
        return None if left else "both empty"
    return (f"{sum(left.values())} <> {sum(right.values())} rows; "
            f"only Spark {list((left - right).items())[:3]}; only SQL {list((right - left).items())[:3]}")
