"""Table changes as jobs that compute the new state of a table.

Plain parquet is not changed in place: every function returns the new rows (or the
change rows) and the caller writes them to a new path or partition. Change sets
must hold one row per key; every function that applies one checks that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.merging import full_join, stored_changes
from millrace.plans.ordered import heat_of, neighbours, running
from millrace.sources.tables import materialise

ACTION = "action"
#: What a chained log holds besides item, time and quantity.
BALANCES = ("current_quantity", "previous_quantity", "previous_date")


def _true(condition: Column) -> Column:
    """A condition that is unknown does not touch the row."""
    return F.coalesce(condition, F.lit(False))


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """UPDATE: all right-hand sides see the old row."""
    hit = _true(condition)
    return df.withColumns({n: F.when(hit, x).otherwise(F.col(n)) for n, x in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE: an unknown condition keeps the row."""
    return df.where(~_true(condition))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version: str | None = None) -> DataFrame:
    """MERGE: insert unknown keys, update known ones, on request only if the
    version column of both sides agrees.

    Returns every row of the new state with an ``action``: insert, update, keep, or
    conflict for a stored row whose change was refused.
    """
    values = [x for x in target.columns if x not in keys]
    t = target.select(*keys, *[F.col(x).alias(f"_t_{x}") for x in values], F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(x).alias(f"_s_{x}") for x in values], F.lit(True).alias("_in_s"))
    both = full_join(t, s, keys)
    matched = F.col("_in_t") & F.col("_in_s")
    agrees = F.col(f"_t_{version}") == F.col(f"_s_{version}") if version else F.lit(True)
    action = (
        F.when(F.col("_in_t").isNull(), "insert")
        .when(F.col("_in_s").isNull(), "keep")
        .when(_true(matched & agrees), "update")
        .otherwise("conflict")
    )
    taken = F.col(ACTION).isin("insert", "update")
    return both.withColumn(ACTION, action).select(
        *keys, *[F.when(taken, F.col(f"_s_{x}")).otherwise(F.col(f"_t_{x}")).alias(x) for x in values], ACTION
    )


def new_state(merged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Table rows after a merge; a conflict leaves the stored row as it was."""
    return merged.select(*columns)


def affected(merged: DataFrame) -> DataFrame:
    """Inserted and updated rows; an error if a merge with input changed nothing."""
    rows = merged.where(F.col(ACTION).isin("insert", "update"))
    if rows.isEmpty() and not merged.where(F.col(ACTION) == "conflict").isEmpty():
        raise RuntimeError("optimistic concurrency violation")
    return rows


def apply_flags(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    insert: Column,
    update: Column,
    delete: Column,
) -> DataFrame:
    """Insert, update and delete by flags of the change rows, in one join."""
    kind = F.when(_true(delete), "delete").when(_true(insert), "insert").when(_true(update), "update")
    marked = changes.select(*keys, *[F.col(x).alias(f"_new_{x}") for x in columns], kind.alias("_kind"))
    both = full_join(target.withColumn("_stored", F.lit(True)), marked, keys)
    stored, k = F.col("_stored").isNotNull(), F.col("_kind")
    stays = stored & F.coalesce(k != "delete", F.lit(True))
    arrives = ~stored & _true(k == "insert")
    use_new = _true(k.isin("insert", "update"))
    return both.where(stays | arrives).select(
        *[
            F.when(use_new, F.col(f"_new_{x}")).otherwise(F.col(x)).alias(x) if x in columns else F.col(x)
            for x in target.columns
        ]
    )


def chain_history(log: DataFrame, item: str, at: str, quantity: str) -> DataFrame:
    """The log with current and previous quantity and previous date of every entry: running
    sums over the entries of an item in the order of time."""
    log = materialise(log.select(item, at, quantity), "history")
    heat = heat_of(log, [item])
    chained = running(
        neighbours(log, [item], [at], previous={"previous_date": at}, heat=heat),
        [item], [at], heat=heat, current_quantity=("sum", F.col(quantity)),
    )
    return _with_previous(chained, quantity)


def _with_previous(chained: DataFrame, quantity: str) -> DataFrame:
    before = F.col("current_quantity") - F.col(quantity)
    return chained.withColumn("previous_quantity", F.when(F.col("previous_date").isNotNull(), before))


def rebuild_history(
    log: DataFrame, changes: DataFrame, item: str, at: str, quantity: str
) -> DataFrame:
    """Insert, replace or (quantity 0) remove entries anywhere in item histories.

    Returns the log with current and previous quantity and previous date. Balances are
    recomputed as running sums instead of shifting later rows one by one. Where the log
    already holds these columns (``BALANCES``, from ``chain_history`` or an earlier change),
    only what the changes reach is recomputed: entries of other items, and those before the
    first change of their item, pass through as they are, and the last of those gives the
    balance from which the recomputed ones go on. An entry without a time is before all
    others.
    """
    keys = [item, at]
    named = changes.select(*keys, F.col(quantity).alias("_q"), F.lit(True).alias("_changed"))
    c = stored_changes(named, keys)

    def changed(entries: DataFrame) -> DataFrame:
        merged = full_join(entries.select(*keys, quantity), c, keys, stored=True)
        merged = merged.withColumn(quantity, F.when(F.col("_changed"), F.col("_q")).otherwise(F.col(quantity)))
        return merged.where((F.col(quantity) != 0) | F.col("_changed").isNull())

    if not set(BALANCES) <= set(log.columns):
        return chain_history(changed(log), item, at, quantity)
    first = c.groupBy(F.col(item).alias("_item")).agg(
        F.min(at).alias("_first"), F.max(F.col(at).isNull()).alias("_whole"), F.lit(True).alias("_touched")
    )
    met = log.join(materialise(first, "first-changes"), F.col(item).eqNullSafe(F.col("_item")), "left")
    touched = F.col("_touched").isNotNull()
    before = ~touched | (~F.col("_whole") & (F.col(at).isNull() | (F.col(at) < F.col("_first"))))
    last = F.max(F.struct(F.col(at).alias("at"), F.col("current_quantity").alias("balance"))).alias("_last")
    carry = materialise(met.where(before & touched).groupBy("_item").agg(last), "carry")

    rebuilt = chain_history(changed(met.where(~before)), item, at, quantity)
    kinds = {f.name: f.dataType for f in rebuilt.schema.fields}
    joined = rebuilt.join(carry, F.col(item).eqNullSafe(F.col("_item")), "left")
    balance = F.col("current_quantity") + F.coalesce(F.col("_last.balance"), F.lit(0))
    moved = joined.withColumns(
        {
            "current_quantity": balance.cast(kinds["current_quantity"]),
            "previous_date": F.coalesce("previous_date", "_last.at"),
        }
    )
    columns = [*keys, quantity, *BALANCES]
    same = met.where(before).select(*[F.col(x).cast(kinds[x]).alias(x) for x in columns])
    return same.unionByName(_with_previous(moved, quantity).select(*[F.col(x).cast(kinds[x]).alias(x) for x in columns]))


def guard_inserts(
    log: DataFrame, candidates: DataFrame, item: str, at: str, quantity: str, order: Sequence[str] = ()
) -> DataFrame:
    """Candidate log rows with ``accepted``: stock may not turn negative and no entry of the
    same or a later time may exist.

    The candidates of an item are judged one after the other, by time, then by the columns
    ``order``, then by quantity; what was accepted changes the stock and is the latest entry
    for the next. A candidate without an item meets no stock and no other candidate; one
    without a quantity is refused; one without a time is judged by the stock alone.

    Candidates that a stored entry refuses are decided by a join. The others are sorted by
    item and time, and each task folds its sorted rows in a stream, holding one batch: the
    decisions of an item depend on each other, so its candidates pass through one task.
    """
    stock = log.groupBy(F.col(item).alias("_item")).agg(F.sum(quantity).alias("_stock"), F.max(at).alias("_last"))
    joined = candidates.join(stock, F.col(item) == F.col("_item"), "left").drop("_item")
    late = F.coalesce(F.col("_last") >= F.col(at), F.lit(False))
    refused = joined.where(late).drop("_stock", "_last").withColumn("accepted", F.lit(False))
    open_ = joined.where(~late).drop("_last")
    sort = [item, at, *order, quantity]
    ordered = open_.repartition(item).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in sort])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, stock, last = None, None, None
        for batch in batches:
            verdicts = []
            for who, when, moved, opening in zip(*(batch.column(c).to_pylist() for c in (item, at, quantity, "_stock"))):
                if who is None or who != current:
                    current, stock, last = who, 0 if opening is None else opening, None
                fits = moved is not None and stock + moved >= 0 and not (when is not None and last is not None and last >= when)
                verdicts.append(fits)
                if fits:
                    stock, last = stock + moved, last if when is None else when
            yield batch.append_column("accepted", pa.array(verdicts, pa.bool_()))

    kinds = T.StructType([*ordered.schema.fields, T.StructField("accepted", T.BooleanType())])
    return ordered.mapInArrow(fold, kinds).drop("_stock").unionByName(refused)


def update_single_row(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """UPDATE that refuses to touch more than one row."""
    if df.where(condition).limit(2).count() > 1:
        raise ValueError("the update would change more than one row")
    return update_where(df, condition, **values)


def change_log(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Old and new value (as text) of every changed cell; NULLs compare as equal."""
    new = stored_changes(new, keys)
    b = new.select(*keys, *[F.col(x).alias(f"_new_{x}") for x in columns])
    both = old.select(*keys, *columns).join(b, list(keys))
    cells = F.array(
        *[
            F.when(
                ~F.col(x).eqNullSafe(F.col(f"_new_{x}")),
                F.struct(
                    F.lit(x).alias("column"),
                    F.col(x).cast("string").alias("old_value"),
                    F.col(f"_new_{x}").cast("string").alias("new_value"),
                ),
            )
            for x in columns
        ]
    )
    return both.select(*keys, F.inline(F.array_compact(cells)))


def audit_rows(inserted: DataFrame, keys: Sequence[str], at: Column, action: str = "INSERT") -> DataFrame:
    """One audit row per changed row."""
    return inserted.select(*keys, F.lit(action).alias("audit_action"), at.alias("audit_at"))


def soft_delete(parents: DataFrame, children: DataFrame, key: str, child_key: str, condition: Column, flag: str):
    """A delete that sets a flag on the parents and, through the key, on their
    children. Returns (parents, children)."""
    hit = _true(condition)
    gone = parents.where(hit).select(F.col(key).alias("_gone")).distinct()
    marked = children.join(gone, F.col(child_key) == F.col("_gone"), "left")
    marked = marked.withColumn(flag, F.col("_gone").isNotNull() | F.col(flag)).drop("_gone")
    return parents.withColumn(flag, hit | F.col(flag)), marked


def cascade_key(children: DataFrame, child_key: str, renamed: DataFrame, old: str, new: str) -> DataFrame:
    """Copy changed parent keys to the child rows."""
    r = stored_changes(renamed, [old]).select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = children.join(r, F.col(child_key) == F.col("_old"), "left")
    return joined.withColumn(child_key, F.coalesce("_new", child_key)).drop("_old", "_new")


def headers_from_details(headers: DataFrame, details: DataFrame, key: str, amount: Column, name: str) -> DataFrame:
    """Header rows with a total computed from their details."""
    totals = details.groupBy(key).agg(F.sum(amount).alias(name))
    return headers.join(totals, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def swap_values(df: DataFrame, column: str, a: object, b: object) -> DataFrame:
    """Swap two values of a unique column in one statement."""
    x = F.col(column)
    return df.withColumn(column, F.when(x == a, F.lit(b)).when(x == b, F.lit(a)).otherwise(x))
