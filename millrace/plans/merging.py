"""Joining a change set onto a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.sources.tables import materialise


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice."""
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"several change rows for one key {list(keys)}")


def stored_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A change set, stored and checked for one row per key. The planner knows the size
    of a stored table and broadcasts it only if that is small in bytes."""
    changes = materialise(changes, "changes")
    require_unique(changes, keys)
    return changes


def full_join(target: DataFrame, changes: DataFrame, keys: Sequence[str], stored: bool = False) -> DataFrame:
    """Full outer join of a table with its change rows, one per key. With ``stored`` the
    changes come from ``stored_changes``.

    A full join would shuffle the table whatever the size of the changes. Stored rows
    with their changes are a left join, and the keys the table lacks an anti join with
    its key columns; the planner broadcasts what is small in either.
    """
    keys = list(keys)
    if not stored:
        changes = stored_changes(changes, keys)
    kept = target.join(changes, keys, "left")
    narrow = changes.select(*keys)
    met = materialise(target.select(*keys).join(narrow, keys, "left_semi").distinct(), "met-keys")
    return kept.unionByName(changes.join(met, keys, "left_anti"), allowMissingColumns=True)
