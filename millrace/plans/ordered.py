"""Ordered computations that stay balanced when one key holds most of the rows.

A window over ``PARTITION BY key ORDER BY x`` puts a whole key into one task, and
a window without keys puts the whole table there. The functions here use the
plain window while every group is small. Larger groups are cut into slices along
the order columns by Spark's range partitioner; each slice is worked on alone, a
one-row summary per slice is scanned for the carry, and the carry is joined back.
Results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources.tables import materialise

#: Largest group (rows) that one task handles; override by this session setting.
HOT_ROWS = 2_000_000
HOT_ROWS_CONF = "millrace.hotRows"
#: Most slices of one table, which bounds the range partitioner's sample; beyond that
#: number slices grow, and a task sorts its slice with spills.
MAX_SLICES = 16_384
SLICES_CONF = "millrace.maxSlices"

START = W.unboundedPreceding

_FOLD = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


def hot_rows(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi join in which NULL keys match, keeping the left key columns once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[x for x in right.columns if x not in keys],
    )
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def with_group_totals(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Attach per-group aggregates by grouping and joining.

    Unlike an unordered window this combines map-side and never holds a whole
    group in one task. The totals are stored first: the planner
    then knows their size and broadcasts them if they are small, which spares the
    large side its shuffle; otherwise a hot key is left to the skew-join split.
    """
    totals = materialise(df.groupBy(*keys).agg(*[x.alias(n) for n, x in aggs.items()]), "totals")
    return join_null_safe(df, totals, keys)


@dataclass(frozen=True)
class Heat:
    """Which groups are hot: none, all, or those of a stored table of keys. It holds for
    every DataFrame with the same rows in each group, so steps that only add columns can
    share it."""

    none: bool = False
    keys: DataFrame | None = None


def heat_of(df: DataFrame, keys: Sequence[str], at_most: int | None = None) -> Heat:
    """Counts the rows, and the groups if there are many rows."""
    limit = hot_rows(df)
    if at_most is not None and at_most <= limit or df.count() <= limit:
        return Heat(none=True)
    if not keys:
        return Heat()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = materialise(counts.where(F.col("_n") > limit).select(*keys), "hot-keys")
    return Heat(none=True) if heavy.isEmpty() else Heat(keys=heavy)


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    at_most: int | None = None,
    heat: Heat | None = None,
) -> DataFrame:
    """Run ``plain`` on groups that fit one task and ``sliced`` on the others.

    ``at_most`` is an upper bound of the row count if one is already known; the
    rows are counted otherwise. The hot keys are a stored table, which is joined as
    its size suggests, so the limit is the same for every table. When hot keys exist
    the input is written once, because the sliced plan reads it for counts, the
    partitioner's sample and its slices. Both plans give the columns and types of ``plain``.
    ``heat``: the answer, if a former step of a chain has found it.
    """
    heat = heat or heat_of(df, keys, at_most)
    if heat.none:
        return plain(df)
    if not hasattr(df, "millrace_path"):
        df = materialise(df, "ordered")
    if heat.keys is None:
        return _typed_like(plain(df), sliced(df))
    usual = plain(join_null_safe(df, heat.keys, keys, "left_anti"))
    return usual.unionByName(_typed_like(usual, sliced(join_null_safe(df, heat.keys, keys, "left_semi"))))


def _typed_like(model: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` in the order and the types of ``model``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in model.schema])


def with_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_slice``, a number that grows with the keys and the order columns.

    A slice is a partition of Spark's range partitioner, so all slices hold about the
    same number of rows whatever the distribution. The rows are stored with the numbers
    of their slices, which therefore stay what they are when a task is run again.
    """
    conf = df.sparkSession.conf
    most = int(conf.get(SLICES_CONF, str(MAX_SLICES)))
    wanted = -(-df.count() // max(1, hot_rows(df) // 2))
    number = min(most, max(wanted, int(conf.get("spark.sql.shuffle.partitions"))))
    ranged = df.repartitionByRange(number, *keys, *order)
    return materialise(ranged.withColumn("_slice", F.spark_partition_id().cast("long")), "slices")


def _grouped(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_group``, the slice and the keys as one column, in place of ``_slice``. Windows and
    the join of the carry both use it, so that one shuffle and one sort of the rows serve
    both; NULL keys are equal inside it."""
    return df.withColumn("_group", F.struct("_slice", *keys)).drop("_slice")


def _with_carry(df: DataFrame, keys: Sequence[str], carry: DataFrame) -> DataFrame:
    """Join one row of each slice and key to rows with ``_group``. They are stored, so the
    planner knows their size; where they are too many for a broadcast, the rows stay where
    the window has put them."""
    return df.join(_grouped(materialise(carry, "carry"), keys).drop(*keys), "_group")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    at_most: int | None = None,
    heat: Heat | None = None,
    **aggs: tuple[str, Column],
) -> DataFrame:
    """Running aggregates, ROWS from the start to the current row.

    ``aggs`` maps an output name to (function, column); the function is one of
    sum, count, min, max. The order columns must identify a row within its key.
    """

    def plain(d: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(START, 0)
        return d.withColumns({n: _FOLD[f][0](x).over(w) for n, (f, x) in aggs.items()})

    return by_heat(df, keys, plain, lambda d: running_sliced(d, keys, order, **aggs), at_most, heat)


def running_sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], **aggs: tuple[str, Column]
) -> DataFrame:
    """``running`` for an input whose keys are all hot."""
    d = with_slices(df, keys, order)
    local = W.partitionBy("_group").orderBy(*order).rowsBetween(START, 0)
    parts = d.groupBy("_slice", *keys).agg(*[_FOLD[f][0](x).alias(f"_p_{n}") for n, (f, x) in aggs.items()])
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(START, -1)
    carry = parts.select(
        "_slice", *keys, *[_FOLD[f][1](F.col(f"_p_{n}")).over(before).alias(f"_c_{n}") for n, (f, _) in aggs.items()]
    )
    d = _grouped(d, keys).withColumns({n: _FOLD[f][0](x).over(local) for n, (f, x) in aggs.items()})
    d = _with_carry(d, keys, carry)
    combined = {}
    for n, (f, _) in aggs.items():
        own, prior = F.col(n), F.col(f"_c_{n}")
        if f in ("sum", "count"):
            combined[n] = F.coalesce(own + prior, own, prior)
        else:
            combined[n] = (F.least if f == "min" else F.greatest)(own, prior)
    return d.withColumns(combined).drop("_group", *[f"_c_{n}" for n in aggs])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn", at_most: int | None = None
) -> DataFrame:
    """ROW_NUMBER over a unique order."""
    return running(df, keys, order, at_most, **{name: ("count", F.lit(1))})


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    at_most: int | None = None,
    heat: Heat | None = None,
) -> DataFrame:
    """LAG and LEAD by one row: ``previous={"prev_val": "val"}``."""
    previous, following = previous or {}, following or {}

    def plain(d: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        return d.withColumns(
            {
                **{n: F.lag(x).over(w) for n, x in previous.items()},
                **{n: F.lead(x).over(w) for n, x in following.items()},
            }
        )

    def sliced(d: DataFrame) -> DataFrame:
        d = with_slices(d, keys, order)
        columns = sorted({*previous.values(), *following.values()})
        row, place = F.struct(*columns), F.struct(*order)
        ends = d.groupBy("_slice", *keys).agg(F.min_by(row, place).alias("_first"), F.max_by(row, place).alias("_last"))
        across = W.partitionBy(*keys).orderBy("_slice")
        carry = ends.select(
            "_slice", *keys, F.lag("_last").over(across).alias("_before"), F.lead("_first").over(across).alias("_after")
        )
        w = W.partitionBy("_group").orderBy(*order)
        d = _grouped(d, keys).withColumns(
            {
                "_inner": F.lag(F.lit(True)).over(w),
                "_outer": F.lead(F.lit(True)).over(w),
                **{n: F.lag(x).over(w) for n, x in previous.items()},
                **{n: F.lead(x).over(w) for n, x in following.items()},
            }
        )
        d = _with_carry(d, keys, carry)
        return d.withColumns(
            {
                **{
                    n: F.when(F.col("_inner"), F.col(n)).otherwise(F.col("_before")[x])
                    for n, x in previous.items()
                },
                **{
                    n: F.when(F.col("_outer"), F.col(n)).otherwise(F.col("_after")[x])
                    for n, x in following.items()
                },
            }
        ).drop("_group", "_inner", "_outer", "_before", "_after")

    return by_heat(df, keys, plain, sliced, at_most, heat)


def row_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    at_most: int | None = None,
    heat: Heat | None = None,
    **aggs: tuple[int, int, Column],
) -> DataFrame:
    """Aggregates over ROWS BETWEEN low AND high around the current row:
    ``avg3=(-2, 0, F.avg("val"))``.

    Hot keys are cut into blocks of consecutive rows; the rows a neighbouring
    block needs for its frames are copied into it and dropped afterwards.
    """

    def framed(d: DataFrame, w) -> DataFrame:
        return d.withColumns({n: x.over(w.rowsBetween(low, high)) for n, (low, high, x) in aggs.items()})

    def plain(d: DataFrame) -> DataFrame:
        return framed(d, W.partitionBy(*keys).orderBy(*order))

    def sliced(d: DataFrame) -> DataFrame:
        back = max(0, *[-low for low, _, _ in aggs.values()])
        ahead = max(0, *[high for _, high, _ in aggs.values()])
        length = max(hot_rows(d), back, ahead)
        d = running_sliced(d, keys, order, _rn=("count", F.lit(1)))
        block = F.floor((F.col("_rn") - 1) / F.lit(length))
        offset = F.pmod(F.col("_rn") - 1, F.lit(length))
        places = F.array(
            F.struct(block.alias("block"), F.lit(False).alias("copy")),
            F.when(offset >= length - back, F.struct((block + 1).alias("block"), F.lit(True).alias("copy"))),
            F.when(offset < ahead, F.struct((block - 1).alias("block"), F.lit(True).alias("copy"))),
        )
        d = d.withColumn("_place", F.explode(F.array_compact(places)))
        d = framed(d, W.partitionBy(*keys, F.col("_place.block")).orderBy("_rn"))
        return d.where(~F.col("_place.copy")).drop("_rn", "_place")

    return by_heat(df, keys, plain, sliced, at_most, heat)


def moving_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], **sums: tuple[int, int, Column]
) -> DataFrame:
    """SUM over ROWS BETWEEN low AND high (both <= 0) as the difference of two
    running sums, so the cost per row does not grow with the frame.

    For exact types. NULLs do not count: a frame without known values gives NULL.
    """
    heat = heat_of(df, keys)
    d = running(
        df, keys, order, heat=heat,
        **{f"_s_{n}": ("sum", x) for n, (_, _, x) in sums.items()},
        **{f"_k_{n}": ("count", x) for n, (_, _, x) in sums.items()},
    )
    ends = {}
    for n, (low, high, _) in sums.items():
        for part in ("s", "k"):
            ends[f"_hi_{part}_{n}"] = (high, high, F.max(f"_{part}_{n}"))
            ends[f"_lo_{part}_{n}"] = (low - 1, low - 1, F.max(f"_{part}_{n}"))
    d = row_frames(d, keys, order, heat=heat, **ends)
    between = lambda part, n: F.col(f"_hi_{part}_{n}") - F.coalesce(f"_lo_{part}_{n}", F.lit(0))
    d = d.withColumns({n: F.when(between("k", n) > 0, between("s", n)) for n in sums})
    return d.drop(*ends, *[f"_{part}_{n}" for n in sums for part in ("s", "k")])


def value_counts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], at_most: int | None = None
) -> DataFrame:
    """One row per key and distinct order value with ``_n`` (rows), ``_upto``
    (rows up to and with it), ``_dense`` (values up to and with it), ``_total``."""
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_n"))
    counts = running(
        counts, keys, order, at_most, _upto=("sum", F.col("_n")), _dense=("count", F.lit(1))
    )
    totals = counts.groupBy(*keys).agg(F.max("_upto").alias("_total"))
    return join_null_safe(counts, totals, keys)


def with_ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], at_most: int | None = None, **names: str
) -> DataFrame:
    """Rank columns with ties: ``rank="rnk", dense_rank="drnk", ...``.

    For hot keys the ranks come from counts of distinct values, so ties are
    counted before anything is ordered.
    """
    windowed = {
        "rank": F.rank,
        "dense_rank": F.dense_rank,
        "percent_rank": F.percent_rank,
        "cume_dist": F.cume_dist,
    }

    kinds = {"rank": "bigint", "dense_rank": "bigint", "percent_rank": "double", "cume_dist": "double"}

    def plain(d: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        return d.withColumns(
            {n: windowed[f]().over(w).cast(kinds[f]) for f, n in names.items()}
        )

    def sliced(d: DataFrame) -> DataFrame:
        counts = value_counts(d, keys, order)
        first = F.col("_upto") - F.col("_n") + 1
        made = {
            "rank": first,
            "dense_rank": F.col("_dense"),
            "percent_rank": F.when(F.col("_total") > 1, (first - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0)),
            "cume_dist": F.col("_upto") / F.col("_total"),
        }
        counts = counts.select(*keys, *order, *[made[f].alias(n) for f, n in names.items()])
        return join_null_safe(d, counts, [*keys, *order])

    return by_heat(df, keys, plain, sliced, at_most)


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    at_most: int | None = None,
    **wanted: tuple[str, float],
) -> DataFrame:
    """Exact percentiles per group: ``median=("cont", 0.5), p50=("disc", 0.5)``.

    Hot groups are reduced to value counts, whose running sum is cut into slices;
    no group is then held as a whole in one task.
    """

    def plain(d: DataFrame) -> DataFrame:
        return d.groupBy(*keys).agg(
            *[
                F.expr(f"percentile_{kind}({p}) within group (order by `{value}`)").cast("double").alias(n)
                for n, (kind, p) in wanted.items()
            ]
        )

    def sliced(d: DataFrame) -> DataFrame:
        counts = value_counts(d, keys, [value])
        upto, total = F.col("_upto"), F.col("_total")
        aggs, final = [], {}
        for name, (kind, p) in wanted.items():
            if kind == "disc":
                aggs.append(F.min(F.when(upto >= F.lit(p) * total, F.col(value))).alias(name))
                final[name] = F.col(name).cast("double")
            else:
                at = F.lit(p) * (total - 1)
                aggs += [
                    F.min(F.when(upto > F.floor(at), F.col(value))).alias(f"_lo_{name}"),
                    F.min(F.when(upto > F.ceil(at), F.col(value))).alias(f"_hi_{name}"),
                    F.max(at - F.floor(at)).alias(f"_f_{name}"),
                ]
                lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
                final[name] = lo + (hi - lo) * F.col(f"_f_{name}")
        return counts.groupBy(*keys).agg(*aggs).select(*keys, *[x.alias(n) for n, x in final.items()])

    return by_heat(df.where(F.col(value).isNotNull()), keys, plain, sliced, at_most)
