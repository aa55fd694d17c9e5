"""Row comparison of a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(df) -> Counter:
    columns = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*columns).toPandas().astype(object).where(lambda p: p.notna(), None).itertuples(index=False, name=None))


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    pdf = con.execute(sql).df()
    columns = sorted(pdf.columns)
    pdf = pdf[columns].astype(object)
    return columns, Counter(pdf.where(pdf.notna(), None).itertuples(index=False, name=None))


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    columns, expected = sql_rows(con, sql)
    if sorted(df.columns) != columns:
        return f"columns {sorted(df.columns)} != {columns}"
    got = rows_of(df)
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; missing {list(missing.items())[:2]},"
        f" extra {list(extra.items())[:2]}"
    )
