"""Run queries and their SQL twins on the same tables and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    return rows.sort_values(list(rows.columns), ignore_index=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty if both hold the same rows in some order."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    ours, theirs = _sorted(ours), _sorted(theirs)
    for name in ours.columns:
        if ours[name].dtype != theirs[name].dtype:
            return f"column {name} is {ours[name].dtype} and {theirs[name].dtype}"
        unequal = (ours[name] != theirs[name]) & ~(ours[name].isna() & theirs[name].isna())
        if unequal.any():
            at = unequal.idxmax()
            return f"{unequal.sum()} rows of {name}: {ours[name][at]!r:.200} and {theirs[name][at]!r:.200}"
    return ""
