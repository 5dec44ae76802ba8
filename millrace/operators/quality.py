"""Dataset rules: each function returns the rows or keys that break a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import Heat, neighbours


def check_violations(df: DataFrame, rule: Column, strict: bool = False) -> DataFrame:
    """Rows failing a CHECK. An unknown result passes, unless ``strict``."""
    return df.where(~F.coalesce(rule, F.lit(False)) if strict else ~rule)


def duplicate_keys(df: DataFrame, keys: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Keys that occur more than once. NULL counts as one value, unless rows with
    a NULL key are exempt."""
    if skip_nulls:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Child rows without a parent; a NULL in any key column exempts the row."""
    on = F.lit(True)
    for c, p in keys.items():
        on = on & (F.col(c) == F.col(f"_p_{p}"))
    wanted = parent.select(*[F.col(p).alias(f"_p_{p}") for p in keys.values()])
    return child.dropna(subset=list(keys)).join(wanted, on, "left_anti")


def broken_chains(
    log: DataFrame, item: str, at: Sequence[str], change: str, current: str, previous: str,
    heat: Heat | None = None,
) -> DataFrame:
    """Log rows whose balance does not add up or does not continue the row before."""
    linked = neighbours(log, [item], at, previous={"_last": current}, heat=heat)
    adds_up = F.col(current) == F.coalesce(previous, F.lit(0)) + F.col(change)
    continues = F.col(previous).eqNullSafe(F.col("_last"))
    fine = F.coalesce(adds_up, F.lit(False)) & continues
    return linked.where(~fine).drop("_last")
