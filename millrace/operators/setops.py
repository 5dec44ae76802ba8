"""Set operations with tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of one row are repeated in pieces of this many.
COPIES = 65_536


def _repeated(df: DataFrame, times: Column) -> DataFrame:
    """Every row as often as ``times`` says (at least once), in pieces, so that no array is
    longer than the number of pieces or a piece."""
    pieces = df.withColumn("_times", times).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / COPIES)))
    )
    size = F.least(F.lit(COPIES), F.col("_times") - F.col("_piece") * COPIES)
    return pieces.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop("_times", "_piece", "_copy")


def table_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows only in the new state (side ``new``) and only in the old (side ``old``),
    duplicates counted and NULLs equal. Both states are counted together, new rows as 1 and
    old ones as -1: one grouping, combined before its shuffle. Copies of a row are repeated
    afterwards."""
    columns = new.columns
    signed = new.withColumn("_n", F.lit(1)).unionAll(old.select(columns).withColumn("_n", F.lit(-1)))
    counted = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "new").otherwise("old")
    return _repeated(counted, F.abs("_n")).select(*columns, side.alias("side"))
