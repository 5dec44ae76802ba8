"""Window patterns that need more than one running computation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.ordered import by_heat, join_null_safe, running, running_sliced, with_group_totals
from millrace.sources.tables import materialise


def running_with_ties(df: DataFrame, keys: Sequence[str], order: str, name: str, measure: str) -> DataFrame:
    """Running SUM in the default RANGE frame: rows with equal order share a total.

    Hot keys are summed per order value first; the running total is taken over
    those sums and joined back, so ties never have to meet in one task.
    """

    def plain(d: DataFrame) -> DataFrame:
        return d.withColumn(name, F.sum(measure).over(W.partitionBy(*keys).orderBy(order)))

    def sliced(d: DataFrame) -> DataFrame:
        sums = d.groupBy(*keys, order).agg(F.sum(measure).alias("_s"))
        sums = running(sums, keys, [order], **{name: ("sum", F.col("_s"))}).drop("_s")
        return join_null_safe(d, sums, [*keys, order])

    return by_heat(df, keys, plain, sliced)


def with_ntile(df: DataFrame, keys: Sequence[str], order: Sequence[str], **tiles: int) -> DataFrame:
    """NTILE over a unique order, derived from the row number and the group size."""

    def plain(d: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        return d.withColumns({name: F.ntile(n).over(w).cast("bigint") for name, n in tiles.items()})

    def sliced(d: DataFrame) -> DataFrame:
        d = running_sliced(d, keys, order, _rn=("count", F.lit(1)))
        d = with_group_totals(d, keys, _rows=F.count(F.lit(1)))
        out = {}
        for name, n in tiles.items():
            small = F.floor(F.col("_rows") / n)
            large = F.col("_rows") % n  # this many tiles hold one row more
            edge = large * (small + 1)
            out[name] = (
                F.when(F.col("_rn") <= edge, F.floor((F.col("_rn") - 1) / (small + 1)) + 1)
                .otherwise(large + F.floor((F.col("_rn") - 1 - edge) / small) + 1)
                .cast("bigint")
            )
        return d.withColumns(out).drop("_rn", "_rows")

    return by_heat(df, keys, plain, sliced)


def with_first_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, first: str, last: str) -> DataFrame:
    """First and last value of the group on every row, from one grouped pass."""
    place = F.struct(*order)
    return with_group_totals(df, keys, **{first: F.min_by(value, place), last: F.max_by(value, place)})


def padded_months(df: DataFrame, key: str, month: str) -> DataFrame:
    """One row per key and calendar month between the first and last month of the
    data; absent months come with NULL measures. The input is read three times, so
    it is stored first."""
    df = materialise(df, "months")
    ends = df.agg(F.struct(F.min(month).alias("a"), F.max(month).alias("b"))).scalar()
    calendar = F.sequence(ends["a"], ends["b"], F.expr("interval 1 month"))
    grid = df.select(key).distinct().select(key, F.explode(calendar).alias(month))
    return grid.join(df, [key, month], "left")
