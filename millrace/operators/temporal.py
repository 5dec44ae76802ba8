"""System-time tables: versions with a half-open period (valid_from, valid_to)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.changes import _true
from millrace.operators.setops import table_diff
from millrace.plans.merging import full_join
from millrace.plans.ordered import neighbours

FROM, TO = "valid_from", "valid_to"
#: End of the period of a version that is still valid.
OPEN = "9999-12-31"


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def versions(df: DataFrame, keys: Sequence[str], at: str, tiebreak: str) -> DataFrame:
    """Change rows to versions: each lasts until the next row of its key."""
    linked = neighbours(df, keys, [at, tiebreak], following={TO: at})
    return linked.withColumnRenamed(at, FROM).withColumn(TO, F.coalesce(TO, moment(OPEN)))


def current(table: DataFrame) -> DataFrame:
    return table.where(F.col(TO) == moment(OPEN))


def history(table: DataFrame) -> DataFrame:
    return table.where(F.col(TO) < moment(OPEN))


def all_versions(now: DataFrame, past: DataFrame) -> DataFrame:
    """Current and history rows with a flag; periods of no length are hidden."""
    both = now.unionByName(past).where(F.col(FROM) < F.col(TO))
    return both.withColumn("is_current", F.when(F.col(TO) == moment(OPEN), 1).otherwise(0).cast("bigint"))


def as_of(table: DataFrame, t: Column) -> DataFrame:
    return table.where((F.col(FROM) <= t) & (F.col(TO) > t))


def from_to(table: DataFrame, a: Column, b: Column) -> DataFrame:
    """Versions active inside (a, b), both ends open. Here and below, periods of no
    length are hidden."""
    return table.where((F.col(FROM) < b) & (F.col(TO) > a) & (F.col(FROM) < F.col(TO)))


def between(table: DataFrame, a: Column, b: Column) -> DataFrame:
    """As ``from_to``, with versions that start exactly at the upper end."""
    return table.where((F.col(FROM) <= b) & (F.col(TO) > a) & (F.col(FROM) < F.col(TO)))


def contained_in(table: DataFrame, a: Column, b: Column) -> DataFrame:
    return table.where((F.col(FROM) >= a) & (F.col(TO) <= b) & (F.col(FROM) < F.col(TO)))


def join_as_of(left: DataFrame, right: DataFrame, on: Sequence[str], t: Column) -> DataFrame:
    """A view over two temporal tables, both read at t. The periods are dropped."""
    a, b = as_of(left, t).drop(FROM, TO), as_of(right, t).drop(FROM, TO)
    return a.join(b, list(on))


def diff(table: DataFrame, t: Column, columns: Sequence[str]) -> DataFrame:
    """What changed between t and now."""
    return table_diff(as_of(table, t).select(*columns), current(table).select(*columns))


def deleted_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest version of every key that has no current one."""
    values = [x for x in table.columns if x not in keys]
    ordered = F.struct(TO, FROM, *[x for x in values if x not in (FROM, TO)])
    last = table.groupBy(*keys).agg(F.max(ordered).alias("_v"))
    gone = last.where(F.col(f"_v.{TO}") < moment(OPEN))
    return gone.select(*keys, *[F.col("_v")[x].alias(x) for x in values])


def write(table: DataFrame, changes: DataFrame, keys: Sequence[str], t: Column, deleted: Column) -> DataFrame:
    """New state of a temporal table after changes at time t.

    ``changes`` holds one row per key with the new values, or a key to delete
    where ``deleted`` is true. A current version that is touched is closed at t;
    an update or insert opens a new one. An unknown ``deleted`` does not delete. A time
    at which a touched version had not begun is refused. History rows pass through
    unchanged.
    """
    values = [x for x in table.columns if x not in (*keys, FROM, TO)]
    fresh = changes.select(
        *keys, F.struct(*values).alias("_new"), _true(deleted).alias("_deleted"), F.lit(True).alias("_touched")
    )
    old = current(table).select(*keys, F.struct(*values).alias("_old"), FROM, F.lit(True).alias("_stored"))
    both = full_join(old, fresh, keys)
    stored, touched = F.col("_stored").isNotNull(), F.col("_touched").isNotNull()
    if not both.where(stored & touched & (F.col(FROM) > t)).isEmpty():
        raise ValueError("a changed version begins after the time of the change")
    version = lambda v, a, b: F.struct(F.col(v).alias("v"), a.alias(FROM), b.alias(TO))
    rows = F.array(
        F.when(stored, version("_old", F.col(FROM), F.when(touched, t).otherwise(moment(OPEN)))),
        F.when(touched & ~F.col("_deleted"), version("_new", t, moment(OPEN))),
    )
    opened = both.select(*keys, F.inline(F.array_compact(rows))).select(*keys, "v.*", FROM, TO)
    return history(table).unionByName(opened)


def add_column(now: DataFrame, past: DataFrame) -> DataFrame:
    """All versions after a column was added to the current rows: NULL in history."""
    return now.unionByName(past, allowMissingColumns=True)


def enable(df: DataFrame, since: Column) -> DataFrame:
    """Give a plain table period columns; every row becomes a current version."""
    return df.withColumns({FROM: since, TO: moment(OPEN)})
