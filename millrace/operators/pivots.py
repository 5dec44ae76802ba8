"""Rows to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot(df: DataFrame, rows: Sequence[str], on: str, values: Sequence, agg: Column) -> DataFrame:
    """Fixed column list. Every row column must be named; nothing groups silently."""
    return df.groupBy(*rows).pivot(on, list(values)).agg(agg)


def pivot_all_other_columns(df: DataFrame, on: str, measure: str, values: Sequence, agg: Column) -> DataFrame:
    """PIVOT on a whole table: each column that is not used becomes a group key."""
    return pivot(df, [x for x in df.columns if x not in (on, measure)], on, values, agg)


def pivot_dynamic(df: DataFrame, rows: Sequence[str], on: str, function: str, measure: str) -> DataFrame:
    """Column list taken from the data. Spark refuses more values than
    ``spark.sql.pivotMaxValues``, so the list read by the driver is bounded."""
    allowed = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "avg": F.avg}
    if function not in allowed:
        raise ValueError(f"unknown aggregate {function}")
    return df.groupBy(*rows).pivot(on).agg(allowed[function](measure))


def with_row_total(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Row total in which a NULL cell counts as zero."""
    total = F.coalesce(columns[0], F.lit(0))
    for x in columns[1:]:
        total = total + F.coalesce(x, F.lit(0))
    return df.withColumn(name, total)


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str, keep_nulls: bool = False) -> DataFrame:
    """Columns to rows; NULL cells are dropped unless asked for."""
    long = df.unpivot(list(keys), list(columns), name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def unpivot_families(
    df: DataFrame, keys: Sequence[str], labels: Sequence, families: dict[str, Sequence[str]], name: str
) -> DataFrame:
    """Several column families at once, ``{"qty": ["q1", "q2"], "val": [...]}``; a
    row stays if any of its measures is known."""
    cells = F.array(
        *[
            F.struct(F.lit(label).alias(name), *[F.col(cols[i]).alias(m) for m, cols in families.items()])
            for i, label in enumerate(labels)
        ]
    )
    long = df.select(*keys, F.inline(cells))
    return long.where(F.coalesce(*families).isNotNull())
