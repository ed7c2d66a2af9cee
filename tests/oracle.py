"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for column in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[column]):
            frame = frame.assign(**{column: frame[column].astype("datetime64[us]")})
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    if list(ours.columns) != list(theirs.columns):
        return f"columns {list(ours.columns)} and {list(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for column in ours.columns:
        a, b = ours[column], theirs[column]
        unequal = ~((a == b) | (a.isna() & b.isna()))
        if unequal.any():
            at = unequal.idxmax()
            return f"{column}: {a[at]!r} and {b[at]!r} in {unequal.sum()} of {len(ours)} rows"
    return None
