"""Sorting by arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_keys(allowed: Sequence[str], *wanted: str) -> list[Column]:
    """Sort columns from up to three arguments such as ``"price desc"``; names
    outside the allowed list are refused."""
    if len(wanted) > 3:
        raise ValueError("at most three sort keys")
    keys = []
    for arg in wanted:
        name, _, direction = arg.partition(" ")
        if name not in allowed or direction.lower() not in ("", "asc", "desc"):
            raise ValueError(f"cannot sort by {arg!r}")
        column = F.col(name)
        keys.append(column.desc_nulls_last() if direction.lower() == "desc" else column.asc_nulls_first())
    return keys


def dynamic_sort(df: DataFrame, allowed: Sequence[str], *wanted: str) -> DataFrame:
    return df.orderBy(*sort_keys(allowed, *wanted))
