"""Filters whose meaning depends on NULLs or on optional arguments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import join_null_safe


def optional_filters(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality filters for the arguments that are not None.

    Only supplied predicates reach the plan, so they can be pushed to the scan.
    """
    given = [F.col(name) == value for name, value in wanted.items() if value is not None]
    return df.where(reduce(Column.__and__, given)) if given else df


def optional_filters_coalesced(df: DataFrame, **wanted: Any) -> DataFrame:
    """The ``col = COALESCE(arg, col)`` form: rows with a NULL column are lost."""
    for name, value in wanted.items():
        df = df.where(F.col(name).isNotNull() if value is None else F.col(name) == value)
    return df


def like_or_equal(column: str, argument: str) -> Column:
    """LIKE when the argument holds a ``%``, equality otherwise: a ``_`` alone is text."""
    if "%" in argument:
        return F.col(column).like(argument)
    return F.col(column) == argument


def starts_with_text(column: str, typed: str) -> Column:
    """Prefix search on user text in which %, _ and [ have no special meaning."""
    return F.col(column).startswith(typed)


def day_range(column: str, low: str, high: str) -> Column:
    """Half-open date range that stays a plain comparison on the column."""
    bound = lambda x: F.lit(x).cast("timestamp_ntz")
    return (F.col(column) >= bound(low)) & (F.col(column) < bound(high))


def not_in(left: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """NOT IN with three-valued logic, as an ordinary anti join.

    A NULL in the list empties the result; a NULL on the left passes only if the
    list is empty. Both cases are decided by a one-row aggregate of the list,
    which avoids the broadcast a null-aware anti join would need.
    """
    listed = values.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"))).scalar()
    size, known = listed["n"], listed["known"]
    kept = left.join(values.select(F.col(value).alias("_listed")), F.col(column) == F.col("_listed"), "left_anti")
    return kept.where((size == known) & (F.col(column).isNotNull() | (size == 0)))


def single_value(df: DataFrame, column: str) -> Column:
    """The one value of a query: NULL for no row, an error for several."""
    return df.select(column).scalar()


def rows_at_maximum(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows of each group that have its largest value; ties stay, NULLs do not count."""
    best = df.groupBy(*keys).agg(F.max(column).alias("_best"))
    return join_null_safe(df, best, keys).where(F.col(column) == F.col("_best")).drop("_best")
