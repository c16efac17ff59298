"""Run a registered query in Spark and in DuckDB over the same files and compare every value."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _rows(df.columns, df.collect())


def duck_rows(con, text):
    result = con.execute(text)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(df, con, text) -> str | None:
    """None when both sides hold the same rows, else a short report."""
    names, ours = spark_rows(df)
    other_names, theirs = duck_rows(con, text)
    if names != other_names:
        return f"columns {names} against {other_names}"
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return (
        f"{sum(ours.values())} against {sum(theirs.values())} rows; "
        f"{len(only_ours)} only in Spark, e.g. {sorted(map(str, only_ours))[:2]}; "
        f"{len(only_theirs)} only in DuckDB, e.g. {sorted(map(str, only_theirs))[:2]} ({names})"
    )
