"""Gaps, islands and missing values in sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.ordered import neighbours, number_rows, running


def gaps(values: DataFrame, column: str) -> DataFrame:
    """Missing ranges between consecutive integers of a column."""
    pairs = neighbours(values.select(column).distinct(), [], [column], following={"_next": column})
    return pairs.where(F.col("_next") - F.col(column) > 1).select(
        (F.col(column) + 1).alias("range_from"), (F.col("_next") - 1).alias("range_to")
    )


def min_missing(values: DataFrame, column: str) -> DataFrame:
    """Smallest positive integer that is absent."""
    keys = values.select(column).where(F.col(column) >= 1).distinct()
    after = keys.select((F.col(column) - 1).alias(column))
    ends = keys.join(after, column, "left_anti").agg(F.min(column).alias("e"), F.count(F.lit(1)).alias("n"))
    has_one = keys.where(F.col(column) == 1).agg(F.count(F.lit(1))).scalar()
    return ends.select(F.when(has_one > 0, F.col("e") + 1).otherwise(F.lit(1)).cast("bigint").alias("missing"))


def islands(values: DataFrame, column: str) -> DataFrame:
    """Ranges of consecutive integers with the number of rows in each.

    Duplicates are counted before ordering, so the row number of the distinct
    values plays the part of a dense rank over all rows.
    """
    counts = values.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    numbered = number_rows(counts, [], [column], "_rn")
    return (
        numbered.groupBy((F.col(column) - F.col("_rn")).alias("_g"))
        .agg(F.min(column).alias("start_range"), F.max(column).alias("end_range"), F.sum("_n").alias("n_rows"))
        .drop("_g")
    )


def date_islands(df: DataFrame, key: str, date: str) -> DataFrame:
    """Ranges of consecutive dates per key with the rows in each. Grouping by day
    first leaves at most one row per calendar day to a window."""
    days = df.groupBy(key, date).agg(F.count(F.lit(1)).alias("_n"))
    rn = F.row_number().over(W.partitionBy(key).orderBy(date))
    return (
        days.withColumn("_g", F.date_sub(date, rn))
        .groupBy(key, "_g")
        .agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"), F.sum("_n").alias("n_rows"))
        .drop("_g")
    )


def sessions(df: DataFrame, keys: Sequence[str], at: str, tiebreak: str, gap: Column) -> DataFrame:
    """Islands that ignore gaps up to ``gap``: start flag, running sum, group."""
    flagged = neighbours(df.select(*keys, at, tiebreak), keys, [at, tiebreak], previous={"_prev": at})
    starts = F.when(F.col("_prev").isNull() | (F.col(at) > F.col("_prev") + gap), 1).otherwise(0)
    numbered = running(flagged.withColumn("_start", starts), keys, [at, tiebreak], session=("sum", F.col("_start")))
    return numbered.groupBy(*keys, "session").agg(
        F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count(F.lit(1)).alias("n_rows")
    )


def label_ranges(df: DataFrame, key: str, number: str, label: str) -> DataFrame:
    """Runs of numbers with one label as text, ``1 - 3 low, 4 high``. The numbers
    of a key are a short series (months, partitions)."""
    rn = F.row_number().over(W.partitionBy(key, label).orderBy(number))
    runs = (
        df.withColumn("_g", F.col(number) - rn)
        .groupBy(key, label, "_g")
        .agg(F.min(number).alias("a"), F.max(number).alias("b"))
    )
    span = F.when(F.col("a") < F.col("b"), F.concat_ws(" - ", "a", "b")).otherwise(F.col("a").cast("string"))
    parts = runs.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("a", F.concat_ws(" ", span, F.col(label)).alias("t")))).alias("p")
    )
    return parts.select(key, F.array_join(F.col("p.t"), ", ").alias("ranges"))
