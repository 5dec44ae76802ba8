"""Masking expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The default masks by type.
DEFAULT_TEXT = "xxxx"
DEFAULT_DATE = "2000-01-01"
EMAIL_TAIL = "XXX@XXXX.com"


def mask_default(df: DataFrame, column: str) -> Column:
    """Text to xxxx, numbers to 0, dates to a fixed date; NULL stays NULL."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        value = F.lit(DEFAULT_TEXT)
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.lit(DEFAULT_DATE).cast(kind)
    else:
        value = F.lit(0).cast(kind)
    return F.when(F.col(column).isNotNull(), value)


def mask_email(s: Column) -> Column:
    return F.concat(F.left(s, F.lit(1)), F.lit(EMAIL_TAIL))


def mask_partial(s: Column, prefix: int, padding: str, suffix: int) -> Column:
    """First and last characters around a padding; too short values show only it."""
    shown = F.concat(
        F.left(s, F.lit(prefix)), F.lit(padding), F.right(s, F.lit(suffix)) if suffix else F.lit("")
    )
    return F.when(F.length(s) < prefix + suffix, F.lit(padding)).otherwise(shown)


def masked(df: DataFrame, unmask: bool, **rules: Column) -> DataFrame:
    """Apply masks as the last step, unless the reader may see clear values.

    Filters, joins and sorts belong before this call; they see clear values.
    """
    return df if unmask else df.withColumns(rules)
