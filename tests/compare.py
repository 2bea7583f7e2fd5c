"""Runs a registered query and its SQL twin on the same tables and compares the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canon(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    return value




def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_canon(r[c]) for c in names) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(_canon(r[i]) for i in order) for r in cur.fetchall()), key=repr)
    return [names[i] for i in order], rows, {n: str(t[1]) for n, t in zip(names, cur.description)}


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def check(spark, con, sf_dir, name, queries, oracle):
    """Problems found, an empty list when both sides agree."""
    df = queries[name](spark, sf_dir)
    s_names, s_rows = spark_rows(df)
    d_names, d_rows, d_types = duck_rows(con, oracle[name])
    problems = []
    if s_names != d_names:
        problems.append(f"columns {s_names} != {d_names}")
    for column, kind in df.dtypes:
        if SPARK_TO_DUCK.get(kind, kind) != d_types.get(column):
            problems.append(f"type of {column}: {kind} / {d_types.get(column)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"{len(s_rows)} rows != {len(d_rows)}")
    if s_rows != d_rows:
        off = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, first: {off}")
    return problems
