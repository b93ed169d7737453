"""Rendering of rows for serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_text(c: Column | str) -> Column:
    """Any value as text; null stays null."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def row_as_json_array(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One JSON array of text values per row, e.g. ``["1","x",null]``."""
    names = list(columns) if columns is not None else df.columns
    return F.to_json(F.array(*[as_text(df[name]) for name in names]))
