"""Run a query in Spark and in DuckDB and compare rows, columns and values."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same bag of rows, else a short description."""
    answer = con.execute(sql)
    names, expected = _rows([d[0] for d in answer.description], answer.fetchall())
    got_names, got = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if got_names != names:
        return f"columns {got_names} != {names}"
    if got == expected:
        return None
    extra, lacking = list((got - expected).elements()), list((expected - got).elements())
    return (
        f"{got.total()} rows, oracle {expected.total()}; {len(extra)} only in Spark, e.g. "
        f"{sorted(extra, key=str)[:2]}; {len(lacking)} only in oracle, e.g. {sorted(lacking, key=str)[:2]}"
    )
