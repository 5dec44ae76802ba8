"""Table changes, dataset rules and temporal tables on small inputs."""

import datetime as dt
import random
import re
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.catalog.common import ntz
from millrace.operators import changes as M
from millrace.operators import joins as J
from millrace.operators import partitions as PA
from millrace.operators import quality as Q
from millrace.operators import routines as R
from millrace.operators import sorting as S
from millrace.operators import temporal as V
from millrace.sources.tables import shared_dir, work_path


@pytest.fixture(params=["broadcast", "shuffled"])
def change_size(spark, request):
    """Apply change sets the planner broadcasts and others."""
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2)], "id int, x string, version int")


@pytest.mark.usefixtures("change_size")
def test_upsert_actions(spark, target, rows):
    source = spark.createDataFrame([(2, "B", 1), (3, "C", 1), (4, "D", 0)], "id int, x string, version int")
    merged = M.upsert(target, source, ["id"], "version")
    assert rows(merged) == [
        (1, "a", 1, "keep"), (2, "B", 1, "update"), (3, "c", 2, "conflict"), (4, "D", 0, "insert"),
    ]
    assert M.affected(merged).count() == 2


@pytest.mark.usefixtures("change_size")
def test_upsert_with_only_conflicts_raises(spark, target):
    source = spark.createDataFrame([(3, "C", 1)], "id int, x string, version int")
    with pytest.raises(RuntimeError, match="concurrency"):
        M.affected(M.upsert(target, source, ["id"], "version"))


def test_upsert_refuses_two_changes_of_one_row(spark, target):
    source = spark.createDataFrame([(3, "C", 1), (3, "D", 1)], "id int, x string, version int")
    with pytest.raises(ValueError):
        M.upsert(target, source, ["id"])


def test_unknown_condition_keeps_the_row(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "id int, v int")
    assert rows(M.delete_where(df, F.col("v") > 3)) == [(1, None), (3, 1)]
    assert rows(M.update_where(df, F.col("v") > 3, v=F.lit(0))) == [(1, None), (2, 0), (3, 1)]


def test_update_sees_old_values(spark, rows):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(M.update_where(df, F.lit(True), a=F.col("b"), b=F.col("a"))) == [(2, 1)]


def test_single_row_guard(spark, target):
    with pytest.raises(ValueError):
        M.update_single_row(target, F.col("version") == 1, x=F.lit("z"))


def test_change_log_is_null_safe(spark, rows):
    old = spark.createDataFrame([(1, None, "p"), (2, "x", None)], "id int, a string, b string")
    new = spark.createDataFrame([(1, None, "q"), (2, None, None)], "id int, a string, b string")
    assert rows(M.change_log(old, new, ["id"], ["a", "b"])) == [(1, "b", "p", "q"), (2, "a", "x", None)]


@pytest.mark.usefixtures("change_size")
def test_history_insert_in_the_middle_and_removal(spark, rows):
    log = spark.createDataFrame([(1, 10, 5), (1, 20, -2), (1, 30, 4)], "item int, at int, q bigint")
    changes = spark.createDataFrame([(1, 15, 1), (1, 30, 0)], "item int, at int, q bigint")
    out = M.rebuild_history(log, changes, "item", "at", "q")
    shown = out.select("at", "q", "current_quantity", "previous_quantity", "previous_date")
    assert rows(shown) == [(10, 5, 5, None, None), (15, 1, 6, 5, 10), (20, -2, 4, 6, 15)]


@pytest.mark.parametrize("kind", ["bigint", "decimal(18,2)"])
def test_stored_history_is_recomputed_where_changes_reach(spark, rows, kind):
    """Against a plain loop: items and times without a value, a hot item, repeated changes."""
    draw = random.Random(5)
    number = int if kind == "bigint" else Decimal
    names = ("item", "at", "q")
    stored = {(i, a): draw.randint(-9, 9) for i in [*range(9), None] for a in draw.sample(range(80), 6)}
    stored |= {(2, a): draw.randint(-9, 9) for a in range(80)} | {(7, None): 4}
    log = M.chain_history(spark.createDataFrame([(i, a, number(q)) for (i, a), q in stored.items()], f"item int, at int, q {kind}"), *names)
    for touched in ([2, 3, 7], [4, 11], []):
        changes = {(i, a): draw.choice([0, 0, 3, -5]) for i in touched for a in draw.sample(range(100), 5)}
        changes |= {(2, 60): 0} if 2 in touched else {}
        given = spark.createDataFrame([(i, a, number(q)) for (i, a), q in changes.items()], f"item int, at int, q {kind}")
        log = M.rebuild_history(log, given, *names)
        stored = {k: q for k, q in (stored | changes).items() if q != 0 or k not in changes}
        wanted = []
        for i in {i for i, _ in stored}:
            total, previous = 0, None
            for a in sorted((a for j, a in stored if j == i), key=lambda a: (a is not None, a)):
                q = stored[i, a]
                wanted.append((i, a, q, total + q, None if previous is None else total, previous))
                total, previous = total + q, a
        plain = [tuple(int(x) if isinstance(x, Decimal) else x for x in r) for r in rows(log.select(*names, *M.BALANCES))]
        assert sorted(plain, key=repr) == sorted(wanted, key=repr)


def test_untouched_items_see_no_window(spark):
    log = M.chain_history(spark.createDataFrame([(1, 10, 5), (1, 20, 1), (2, 10, 7)], "item int, at int, q bigint"), "item", "at", "q")
    marked = log.withColumn("current_quantity", F.when(F.col("item") == 2, 700).otherwise(F.col("current_quantity")))
    change = spark.createDataFrame([(1, 20, 2)], "item int, at int, q bigint")
    out = M.rebuild_history(marked, change, "item", "at", "q")
    assert sorted(tuple(r) for r in out.select("item", "at", "current_quantity").collect()) == [(1, 10, 5), (1, 20, 7), (2, 10, 700)]


def test_guarded_inserts(spark, rows):
    log = spark.createDataFrame([(1, 10, 5), (2, 10, 5), (3, 50, 9)], "item int, at int, q int")
    tries = spark.createDataFrame([(1, 20, -5), (2, 20, -6), (3, 20, -1), (4, 20, -1)], "item int, at int, q int")
    out = M.guard_inserts(log, tries, "item", "at", "q").select("item", "accepted")
    assert rows(out) == [(1, True), (2, False), (3, False), (4, False)]


@pytest.mark.parametrize("kind", ["int", "decimal(12,2)"])
def test_guarded_inserts_one_after_the_other(spark, rows, kind):
    """Against a plain loop: several candidates of an item, ties, a hot item, unknown values."""
    draw = random.Random(11)
    log = [(i, draw.randint(0, 30), draw.randint(-3, 9)) for i in range(12) for _ in range(4)] + [(None, 5, 100)]
    tries = [
        (n, draw.choice([0, 0, 0, *range(15), None]), draw.choice([*range(20, 60), None]), draw.choice([*range(-8, 6), None]))
        for n in range(400)
    ]
    kinds = f"item int, at int, q {kind}"
    number = (lambda q: q) if kind == "int" else (lambda q: None if q is None else Decimal(q))
    stored = spark.createDataFrame([(i, a, number(q)) for i, a, q in log], kinds)
    wanted = spark.createDataFrame([(n, i, a, number(q)) for n, i, a, q in tries], f"n int, {kinds}")
    known = lambda x: (x is not None, x or 0)
    verdicts, state = [], {}
    for n, i, a, q in sorted(tries, key=lambda r: (known(r[2]), r[0])):
        mine = [(at, moved) for item, at, moved in log if item == i and i is not None]
        stock, last = state.get(i) or (sum(m for _, m in mine), max((at for at, _ in mine), default=None))
        fits = q is not None and stock + q >= 0 and (a is None or last is None or last < a)
        verdicts.append((n, fits))
        if fits and i is not None:
            state[i] = stock + q, a if a is not None and (last is None or a > last) else last
    out = M.guard_inserts(stored, wanted.repartition(7), "item", "at", "q", ["n"])
    assert out.columns == ["n", "item", "at", "q", "accepted"]
    assert rows(out.select("n", "accepted")) == sorted(verdicts, key=repr)


def test_swap_keeps_values_unique(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, x string")
    swapped = M.swap_values(df, "x", "a", "b")
    assert rows(swapped) == [(1, "b"), (2, "a"), (3, "c")]
    assert Q.duplicate_keys(swapped, ["x"]).isEmpty()


def test_check_lets_unknown_pass(spark, rows):
    boxes = spark.createDataFrame([(1, 9, None, 3), (2, 1, 2, 3), (3, 3, 2, 1)], "id int, a int, b int, c int")
    chain = (F.col("a") <= F.col("b")) & (F.col("b") <= F.col("c"))
    ids = lambda df: rows(df.select("id"))
    assert ids(Q.check_violations(boxes, chain)) == [(3,)]
    assert ids(Q.check_violations(boxes, chain & (F.col("a") <= F.col("c")))) == [(1,), (3,)]
    assert ids(Q.check_violations(boxes, chain, strict=True)) == [(1,), (3,)]


def test_composite_foreign_key_with_null_part(spark, rows):
    child = spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, 9, 9)], "id int, a int, b int")
    parent = spark.createDataFrame([(1, 1)], "pa int, pb int")
    assert rows(Q.orphans(child, parent, {"a": "pa", "b": "pb"}).select("id")) == [(3,)]


def test_unique_with_nulls(spark, rows):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,)], "k int")
    assert rows(Q.duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]
    assert rows(Q.duplicate_keys(df, ["k"], skip_nulls=True)) == [(1, 2)]


def test_broken_chain(spark, rows):
    log = spark.createDataFrame(
        [(1, 1, 5, 5, None), (1, 2, 2, 8, 5), (1, 3, 1, 9, 8)], "item int, at int, q int, cur int, prev int"
    )
    assert rows(Q.broken_chains(log, "item", ["at"], "q", "cur", "prev").select("at")) == [(2,)]


DAY = lambda n: dt.datetime(2024, 1, n)


@pytest.fixture
def table(spark):
    rows = [(1, "a", DAY(1), DAY(5)), (1, "b", DAY(5), dt.datetime(9999, 12, 31)), (2, "c", DAY(2), DAY(4))]
    return spark.createDataFrame(rows, "id int, x string, valid_from timestamp_ntz, valid_to timestamp_ntz")


def test_period_boundaries(table, rows):
    at = lambda n: ntz(f"2024-01-0{n}")
    xs = lambda df: [r[0] for r in rows(df.select("x"))]
    assert xs(V.as_of(table, at(5))) == ["b"]
    assert xs(V.as_of(table, at(4))) == ["a"]
    assert xs(V.from_to(table, at(4), at(5))) == ["a"]
    assert xs(V.between(table, at(4), at(5))) == ["a", "b"]
    assert xs(V.contained_in(table, at(1), at(5))) == ["a", "c"]


@pytest.mark.usefixtures("change_size")
def test_temporal_write(spark, table, rows):
    changes = spark.createDataFrame([(1, "z", False), (3, "n", False)], "id int, x string, gone boolean")
    out = V.write(table, changes, ["id"], ntz("2024-01-09"), F.col("gone"))
    assert rows(out.select("id", "x", F.dayofmonth("valid_from"), F.year("valid_to"))) == [
        (1, "a", 1, 2024), (1, "b", 5, 2024), (1, "z", 9, 9999), (2, "c", 2, 2024), (3, "n", 9, 9999),
    ]


def test_deleted_rows(table, rows):
    assert rows(V.deleted_rows(table, ["id"]).select("id", "x")) == [(2, "c")]


def numbers(spark, *ends):
    return spark.range(*ends).withColumnRenamed("id", "k")


def test_switch_in_checks_bounds(spark):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "switch-test"), "k", [F.lit(5), F.lit(10)])
    with pytest.raises(ValueError, match="bounds"):
        table.switch_in(numbers(spark, 10), 3)
    with pytest.raises(ValueError, match="bounds"):
        table.switch_in(spark.createDataFrame([(None,)], "k bigint"), 3)
    table = table.switch_in(numbers(spark, 12, 15), 3)
    assert table.read().groupBy("bucket").count().count() == 3


def test_merge_of_a_filled_partition_is_refused(spark, rows):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "merge-test"), "k", [F.lit(5)])
    with pytest.raises(ValueError, match="not empty"):
        table.merge(1)
    with pytest.raises(ValueError, match="no next"):
        table.merge(2)
    assert rows(table.merge(1, filled=True).read()) == [(k, 1) for k in range(10)]


def files_of(table):
    return {p.name: sorted(f.name for f in p.iterdir()) for p in (Path(table.path.removeprefix("file:")) / "data").iterdir() if p.is_dir()}


def test_split_writes_one_partition(spark, rows):
    some = numbers(spark, 30).unionByName(spark.createDataFrame([(None,)], "k bigint"))
    table = PA.PartitionedTable.create(some, work_path(spark, "split-test"), "k", [F.lit(10), F.lit(20)])
    before = files_of(table)
    after = table.split(F.lit(13))
    written = files_of(after)
    assert {n: f for n, f in written.items() if n in before} == before and len(written) == len(before) + 2
    expected = [(k, 1 + (k >= 10) + (k >= 13) + (k >= 20)) for k in range(30)] + [(None, 1)]
    assert rows(after.read()) == sorted(expected, key=repr)
    assert rows(table.read().where("bucket = 2").select("k")) == [(k,) for k in range(10, 20)]  # the list before
    with pytest.raises(ValueError, match="begins here"):
        after.split(F.lit(20))
    after.clean()
    assert len(files_of(after)) == 4
    assert rows(PA.PartitionedTable(spark, table.path).read()) == sorted(expected, key=repr)


def test_of_two_changes_of_one_list_one_fails(spark, rows):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "race-test"), "k", [F.lit(5)])
    table.split(F.lit(7))
    with pytest.raises(Exception, match="[Ee]xist"):
        table.switch_out(1, "low")
    again = PA.PartitionedTable(spark, table.path)
    assert again.version == 2 and not again.archives and again.read().count() == 10


def test_change_that_stops_half_way_changes_nothing(spark, monkeypatch):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "stop-test"), "k", [F.lit(5)])

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(PA, "rename_new", stop)
        for change in (lambda: table.split(F.lit(7)), lambda: table.switch_out(2, "high")):
            with pytest.raises(OSError):
                change()
    again = PA.PartitionedTable(spark, table.path)
    assert again.version == 1 and again.read().count() == 10
    assert again.switch_out(2, "high").switched_out("high").count() == 5


def test_partition_number_prunes_folders(spark):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "prune-test"), "k", [F.lit(5)])
    plan = table.read().where("bucket = 2")
    assert len(plan.select(F.input_file_name().alias("f")).distinct().collect()) >= 1
    assert re.search(r"PartitionFilters: \[[^]]+part", plan._jdf.queryExecution().executedPlan().toString())


def test_partitions_of_an_empty_table(spark, rows):
    table = PA.PartitionedTable.create(numbers(spark, 0), work_path(spark, "no-rows"), "k", [F.lit(5)])
    assert rows(table.read()) == [] and table.read().columns == ["k", "bucket"]
    table = table.split(F.lit(9)).switch_in(numbers(spark, 5, 7), 2)
    assert rows(table.read()) == [(5, 2), (6, 2)]


def test_boundary_belongs_to_the_right(spark, rows):
    df = spark.createDataFrame([(4,), (5,), (6,)], "k int")
    assert rows(df.select("k", PA.partition_number(F.col("k"), [F.lit(5)]))) == [(4, 1), (5, 2), (6, 2)]


def test_sort_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        S.sort_keys(["a"], "b")
    with pytest.raises(ValueError):
        S.sort_keys(["a"], "a; drop")
    assert len(S.sort_keys(["a", "b"], "a desc", "b")) == 2


def test_result_contract(spark):
    with pytest.raises(ValueError):
        R.with_result_schema(spark.range(1), ("a", "int"), ("b", "int"))


class _Fake:
    """A session without a named shared folder."""

    def __init__(self, master):
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{master}"
        self.conf = self

    def get(self, name, default=None):
        return default

    def getCheckpointDir(self):
        return None


def test_shared_folder_must_be_named_on_a_cluster():
    assert shared_dir(_Fake("local[2]")) == shared_dir(_Fake("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Fake("spark://host:7077"))


def test_shared_folder_of_the_session_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named.rstrip("/")


def two_rows(spark, schema, a, b):
    return spark.createDataFrame([a, b], schema)


def test_two_changes_of_one_key_are_refused_everywhere(spark, target):
    twice = two_rows(spark, "id int, x string, version int", (2, "p", 1), (2, "q", 1))
    with pytest.raises(ValueError, match="several change rows"):
        J.overlay_values(target, twice, ["id"], ["x"])
    with pytest.raises(ValueError, match="several change rows"):
        M.change_log(target, twice, ["id"], ["x"])
    with pytest.raises(ValueError, match="several change rows"):
        M.cascade_key(target, "id", two_rows(spark, "old int, new int", (1, 5), (1, 6)), "old", "new")


def test_wide_changes_are_not_broadcast(spark, target):
    wide = spark.range(3, 2000).select(
        F.col("id").cast("int").alias("id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 100).alias("x"), F.lit(1).alias("version")
    )
    merged = M.upsert(target.repartition(2), wide, ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        plan = M.upsert(target.repartition(2), wide, ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search("SortMergeJoin.*LeftOuter", plan)  # only the list of met keys may be broadcast
    assert merged.count() == 1999


def test_switch_in_refuses_a_filled_partition(spark):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "switch-filled"), "k", [F.lit(5)])
    with pytest.raises(ValueError, match="not empty"):
        table.switch_in(numbers(spark, 7, 8), 2)
    assert table.read().count() == 10


def test_switched_out_rows_leave_the_table(spark, rows):
    table = PA.PartitionedTable.create(numbers(spark, 10), work_path(spark, "switch-left"), "k", [F.lit(5)])
    table = table.switch_out(1, "low")
    assert rows(table.read().select("k")) == [(k,) for k in range(5, 10)]
    assert rows(table.switched_out("low")) == [(k,) for k in range(5)]
    with pytest.raises(ValueError, match="archive"):
        table.switch_out(2, "low")
    table = table.switch_in(numbers(spark, 3), 1)
    table.clean()
    assert table.read().count() == 8 and table.switched_out("low").count() == 5


def test_unknown_deletion_does_not_delete(spark, table, rows):
    changes = spark.createDataFrame([(1, "z", None)], "id int, x string, gone boolean")
    out = V.write(table, changes, ["id"], ntz("2024-01-09"), F.col("gone"))
    assert rows(V.current(out).select("id", "x")) == [(1, "z")]


def test_early_change_is_refused(spark, table):
    changes = spark.createDataFrame([(1, "z", False)], "id int, x string, gone boolean")
    with pytest.raises(ValueError, match="begins after"):
        V.write(table, changes, ["id"], ntz("2024-01-04"), F.col("gone"))


def test_periods_of_no_length_are_hidden(spark):
    empty = spark.createDataFrame([(1, "a", DAY(3), DAY(3))], "id int, x string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    a, b = ntz("2024-01-01"), ntz("2024-01-09")
    assert [f(empty, a, b).count() for f in (V.from_to, V.between, V.contained_in)] == [0, 0, 0]
    assert V.all_versions(empty, empty).count() == 0
