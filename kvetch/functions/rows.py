"""Rows from array elements, without computing the arrays twice.

For an inner ``explode`` the optimizer adds a test that the array is not empty, and pushes
that test and any other on the array down to the scan. An array computed from text or by a
Python function would then be computed once for the test and once more for the rows. The
outer form with a test on its result has the same rows and stops that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(
    df: DataFrame,
    items: Column | str,
    name: str,
    *kept: Column | str,
    pos: str | None = None,
    nulls: bool = False,
) -> DataFrame:
    """The ``kept`` columns and one row per element; with ``pos`` also its place from 0.

    What is kept is computed once per input row, not once per element. With ``nulls`` an
    array that is NULL or empty gives a row too, and NULL elements stay.
    """
    rows = df.select(*kept, (F.col(items) if isinstance(items, str) else items).alias("_items"))
    names = [F.col(f"`{column}`") for column in rows.columns[:-1]]
    if pos is None:
        exploded = rows.select(*names, F.explode_outer("_items").alias(name))
    else:
        exploded = rows.select(*names, F.posexplode_outer("_items").alias(pos, name))
    return exploded if nulls else exploded.where(F.col(pos or name).isNotNull())


def where_not_empty(df: DataFrame, name: str) -> DataFrame:
    """The rows whose array ``name`` has elements."""
    kept = [column for column in df.columns if column != name]
    full = F.filter(F.array(F.col(name)), lambda items: F.size(items) > 0)
    return explode_rows(df, full, name, *kept)
