"""Joins beyond the plain equi join."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.plans.merging import stored_changes
from millrace.plans.ordered import running


def left_outer_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN whose right side may have a hot key.

    Spark can split a skewed partition of an outer join only on the preserved
    side. The inner part can be split on both sides; the unmatched rows come from
    an anti join with the distinct right keys.
    """
    on = F.col(left_key) == F.col(right_key)
    lonely = left.join(right.select(right_key).distinct(), on, "left_anti")
    return left.join(right, on).unionByName(lonely, allowMissingColumns=True)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_name: str = "rn"
) -> DataFrame:
    """The first n rows of each group. The rank filter lets Spark cut every group
    to n rows before the shuffle, so a hot group costs no more than another."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w).cast("bigint")).where(F.col(rank_name) <= n)


def lateral_top_n(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    order: Sequence[Column],
    n: int,
    outer: bool = False,
) -> DataFrame:
    """Each left row with its first n right rows; ``outer`` keeps unmatched rows."""
    best = top_n_per_group(right, [right_key], order, n)
    return left.join(best, F.col(left_key) == F.col(right_key), "left" if outer else "inner")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    tiebreak: str,
    take: Sequence[str],
    strict: bool = True,
) -> DataFrame:
    """Each left row with columns of the latest earlier right row of its keys.

    Both sides are stacked and a running maximum carries the last right row
    forward; with ``strict`` a right row at the very same time does not count.
    ``take`` columns appear prefixed with ``prior_``.
    """
    carried = F.struct(at, tiebreak, *[x for x in take if x not in (at, tiebreak)])
    blank = F.lit(None)
    lhs = left.select(
        *left.columns, F.lit(False).alias("_is_right"), F.lit(0 if strict else 1).alias("_turn")
    )
    rhs = right.select(
        *keys, at, tiebreak, carried.alias("_carried"), F.lit(True).alias("_is_right"),
        F.lit(1 if strict else 0).alias("_turn"),
    )
    both = lhs.withColumn("_carried", blank.cast(rhs.schema["_carried"].dataType)).unionByName(
        rhs, allowMissingColumns=True
    )
    both = running(both, keys, [at, "_turn", tiebreak], _prior=("max", F.col("_carried")))
    return both.where(~F.col("_is_right")).select(
        *left.columns, *[F.col("_prior")[x].alias(f"prior_{x}") for x in take]
    )


def _position(df: DataFrame, column: str) -> Column:
    """A number that does not fall when the column grows: days of a date, seconds of a
    timestamp with or without zone, the number itself."""
    kind = df.schema[column].dataType.typeName()
    x = F.col(column)
    if kind == "date":
        return F.unix_date(x).cast("double")
    if kind == "timestamp":
        return F.unix_seconds(x).cast("double")
    if kind == "timestamp_ntz":
        clock = F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)
        return (F.unix_date(x.cast("date")).cast("double") * 86_400 + clock).cast("double")
    return x.cast("double")


#: Interval lengths are sorted into levels; the bins of a level are twice as wide as those below.
MAX_LEVEL = 62


def overlapping(
    left: DataFrame,
    right: DataFrame,
    left_ends: tuple[str, str],
    right_ends: tuple[str, str],
    keys: Sequence[str] = (),
    closed: bool = True,
    width: float | None = None,
) -> DataFrame:
    """Pairs of left and right rows of the same keys whose intervals overlap.

    ``left_ends`` and ``right_ends`` name start and end: dates, timestamps or numbers, of
    one type on both sides. ``closed`` intervals that touch overlap; half-open ones
    (end excluded) do not, and those of no length overlap nothing. An interval that ends
    before it starts, or has a NULL end or key, overlaps nothing. The columns of both sides
    must differ but for the keys.

    The join is an equality join on bins. ``width`` is that of the narrowest bins (days,
    seconds or units); without it the median length of the right side is taken. A longer
    interval belongs to the level whose bins are as wide as it is long, so it touches two
    bins at most, whatever the lengths. Each row is sent to its bins of its own level and
    of the coarser ones that the other side has; a pair meets on the coarser of its two
    levels, in the bin of the later start, and so exactly once. A bin that holds very many
    rows is split by adaptive execution.
    """
    sides = [(left, *left_ends), (right, *right_ends)]
    known = []
    for df, start, end in sides:
        fit = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
        known.append(df.where(fit if closed else fit & (F.col(start) < F.col(end))))
    length = _position(right, right_ends[1]) - _position(right, right_ends[0])
    if width is None:
        width = known[1].agg(F.percentile_approx(length, 0.5)).first()[0] or 1.0
    if not width > 0:
        raise ValueError("the bin width must be positive")

    def level(df: DataFrame, start: str, end: str) -> Column:
        long = _position(df, end) - _position(df, start)
        return F.when(long <= width, 0).otherwise(F.least(F.lit(MAX_LEVEL), F.ceil(F.log2(long / width)))).cast("int")

    used = [
        [int(x) for x in df.agg(F.array_sort(F.collect_set(level(df, start, end)))).first()[0]]
        for df, (_, start, end) in zip(known, sides)
    ]
    sent = []
    for i, (df, (_, start, end)) in enumerate(zip(known, sides)):
        own = f"_own_{i}"
        met = F.array_union(F.array(own), F.filter(F.array(*[F.lit(x) for x in used[1 - i]]).cast("array<int>"), lambda x: x > F.col(own)))
        step = F.pow(F.lit(2.0), F.col("_level")) * width
        first, last = (F.floor(_position(df, c) / step) for c in (start, end))
        df = df.withColumn(own, level(df, start, end)).withColumn("_level", F.explode(met))
        df = df.withColumn(f"_first_{i}", first).withColumn("_bin", F.explode(F.sequence(first, last)))
        renamed = {k: f"_k_{k}" for k in keys} if i else {}
        sent.append(df.withColumnsRenamed(renamed | ({"_level": "_level_1", "_bin": "_bin_1"} if i else {})))
    a, b = sent
    same = (F.col("_level") == F.col("_level_1")) & (F.col("_bin") == F.col("_bin_1"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    (ls, le), (rs, re) = left_ends, right_ends
    touch = (F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) if closed else (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le))
    once = (F.greatest("_own_0", "_own_1") == F.col("_level")) & (F.greatest("_first_0", "_first_1") == F.col("_bin"))
    right_columns = [c for c in right.columns if c not in keys]
    return a.join(b, same & touch & once).select(*left.columns, *right_columns)


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    at: str,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    closed: bool = True,
    width: float | None = None,
) -> DataFrame:
    """Pairs of a point and an interval of the same keys that holds it; the end belongs to
    the interval if it is ``closed``. Otherwise as ``overlapping``."""
    if closed:
        return overlapping(points, intervals, (at, at), (start, end), keys, True, width)
    some = intervals.where(F.col(start) < F.col(end))
    met = overlapping(points, some, (at, at), (start, end), keys, True, width)
    return met.where(F.col(at) < F.col(end))


def id_list(spark: SparkSession, text: str, sep: str = ",") -> DataFrame:
    """An id list argument as rows (pos, id): delimited, or a JSON array of numbers."""
    ids = json.loads(text) if text.lstrip().startswith("[") else [int(x) for x in text.split(sep)]
    return spark.createDataFrame(list(enumerate(ids, start=1)), "pos bigint, id bigint")


def join_id_list(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of the listed ids with their list position. The list may be an argument
    typed by the caller (``id_list``) or any table with ``id`` and ``pos``; the planner
    broadcasts it if it is small."""
    return df.join(ids, F.col(key) == F.col("id")).drop("id")


def divide(df: DataFrame, key: str, member: str, divisor: DataFrame, all_if_empty: bool = False) -> DataFrame:
    """Keys related to every member of the divisor; members that are NULL do not count.

    An empty divisor gives no key, as counting members does; with ``all_if_empty`` it
    gives every key, as the form NOT EXISTS (... NOT EXISTS ...) does.
    """
    wanted = divisor.select(F.col(member).alias("_wanted")).where("_wanted IS NOT NULL").distinct()
    needed = wanted.agg(F.count(F.lit(1))).scalar()
    related = df.join(wanted, F.col(member) == F.col("_wanted"), "left" if all_if_empty else "inner")
    met = related.groupBy(key).agg(F.count_distinct("_wanted").alias("_met"))
    return met.where(F.col("_met") == needed).select(key)


def overlay_values(target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Target rows with the columns replaced where a change is given."""
    fresh = stored_changes(changes, keys).select(*keys, *[F.col(x).alias(f"_new_{x}") for x in columns])
    joined = target.join(fresh, list(keys), "left")
    return joined.withColumns({x: F.coalesce(f"_new_{x}", x) for x in columns}).drop(
        *[f"_new_{x}" for x in columns]
    )
