"""Order-free comparison of results, and access to DuckDB over a folder of tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return value.normalize() + 0
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(row[i]) for i in order] for row in rows), key=repr)


def assert_equals_sql(df, con, sql):
    want = con.execute(sql)
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    rows = want.fetchall()
    assert normal(df.columns, df.collect()) == normal(columns, rows)
    return len(rows)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df):
    """The plan as it ran, after adaptive changes."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
