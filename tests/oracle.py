"""Compare a query with the SQL that states its result, column by column, value by value."""

import math
from pathlib import Path

import duckdb

import __spark_entry__ as spark_entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    )


def differences(spark, con, name, folder):
    """None when equal, else a short description."""
    df = spark_entry.queries()[name](spark, folder)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        if banned in plan:
            return f"{banned} in the plan"
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    want_cols, want = _rows([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    return None
