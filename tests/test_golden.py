"""Small hand-checked inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates as D
from millrace.functions import json as JS
from millrace.functions import masking as K
from millrace.functions import text as X
from millrace.operators import aggregates as A
from millrace.operators import filters as FI
from millrace.operators import graph as G
from millrace.operators import islands as I
from millrace.operators import joins as J
from millrace.operators import pivots as P
from millrace.operators import setops as U
from millrace.plans import ordered as O
from millrace.sources.documents import order_lines, order_xml

T1 = [2, 3, 11, 12, 13, 31, 33, 34, 35, 42]  # islands 2-3, 11-13, 31, 33-35, 42


@pytest.fixture
def t1(spark):
    return spark.createDataFrame([(x,) for x in T1], "k bigint")


def test_gaps(t1, rows):
    assert rows(I.gaps(t1, "k")) == [(14, 30), (32, 32), (36, 41), (4, 10)]


def test_gaps_sliced(t1, rows, tiny_tasks, spark):
    many = t1.union(spark.range(100, 200).withColumnRenamed("id", "k"))
    assert (43, 99) in rows(I.gaps(many, "k"))


def test_islands(t1, rows):
    doubled = t1.union(t1.where("k = 12"))
    assert rows(I.islands(doubled, "k")) == [(11, 13, 4), (2, 3, 2), (31, 31, 1), (33, 35, 3), (42, 42, 1)]


@pytest.mark.parametrize("values, expected", [([1, 2, 3, 7], 4), ([2, 3], 1), ([1], 2), ([0, -1], 1)])
def test_min_missing(spark, values, expected):
    df = spark.createDataFrame([(x,) for x in values], "k bigint")
    assert I.min_missing(df, "k").first()[0] == expected


def test_sessions_ignore_small_gaps(spark, rows):
    at = lambda d: dt.datetime(2024, 1, d)
    df = spark.createDataFrame([(1, at(d), d) for d in (1, 5, 12, 20)], "k int, at timestamp_ntz, id int")
    out = I.sessions(df, ["k"], "at", "id", F.expr("interval 7 days"))
    assert rows(out.select("session", "n_rows")) == [(1, 3), (2, 1)]


def test_label_ranges(spark):
    df = spark.createDataFrame([(1, n, "low" if n != 3 else "high") for n in (1, 2, 3, 4)], "k int, n int, t string")
    assert I.label_ranges(df, "k", "n", "t").first()["ranges"] == "1 - 2 low, 3 high, 4 low"


def test_subtree_levels_and_cycles(spark, rows):
    edges = [(1, None), (2, 1), (3, 1), (4, 2), (5, 4), (6, 7), (7, 6)]
    nodes = spark.createDataFrame(edges, "id int, boss int")
    out = G.subtree(nodes, "id", "boss", 1)
    assert rows(out.select("id", "lvl")) == [(1, 0), (2, 1), (3, 1), (4, 2), (5, 3)]
    assert rows(G.subtree(nodes, "id", "boss", 1, max_levels=1).select("id")) == [(1,), (2,), (3,)]
    assert rows(G.subtree(nodes, "id", "boss", 6).select("id", "lvl")) == [(6, 0), (7, 1)]
    assert rows(G.subtree(nodes, "id", "boss", 1, max_levels=0).select("id", "lvl")) == [(1, 0)]
    with pytest.raises(ValueError, match="cycle"):
        G.subtree(nodes, "id", "boss", 1, refuse_cycles=True)
    assert rows(G.subtree(nodes.where("id < 6"), "id", "boss", 2, refuse_cycles=True).select("id")) == [(2,), (4,), (5,)]
    assert rows(G.subtree(nodes, "id", "boss", 77).select("id")) == []


def test_subtree_of_a_long_chain_takes_few_steps(spark, monkeypatch):
    stored = []
    keep = G.materialise
    monkeypatch.setattr(G, "materialise", lambda df, name: stored.append(name) or keep(df, name))
    n = 10_000
    chain = spark.range(n).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("boss"))
    out = G.subtree(chain, "id", "boss", 3)
    assert out.where(F.col("lvl") != F.col("id") - 3).isEmpty() and out.count() == n - 3
    assert len(stored) <= 9
    assert G.subtree(chain, "id", "boss", 0, max_levels=70).count() == 71


def test_subtree_equals_a_plain_walk(spark, rows):
    draw = random.Random(3)
    above = {i: draw.choice([None, draw.randint(0, 199), 5]) for i in range(200)}  # cycles, several roots, a hot parent
    nodes = spark.createDataFrame(list(above.items()), "id int, boss int")
    for most in (None, 1, 2, 5):
        level, frontier, lvl = {5: 0}, [5], 0
        while frontier and (most is None or lvl < most):
            lvl += 1
            frontier = [i for i, up in above.items() if up in frontier and i not in level]
            level.update(dict.fromkeys(frontier, lvl))
        assert rows(G.subtree(nodes, "id", "boss", 5, max_levels=most).select("id", "lvl")) == sorted(level.items(), key=repr)


def test_common_targets_include_the_node_itself(spark, rows):
    edges = spark.createDataFrame([(1, 9), (4, 9), (2, 5)], "src int, dst int")
    assert rows(G.common_targets(edges).select("src", "other")) == [(1, 1), (1, 4), (2, 2), (4, 1), (4, 4)]


def test_not_in_three_valued(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    with_null = spark.createDataFrame([(1,), (None,)], "v int")
    known = with_null.where("v IS NOT NULL")
    empty = with_null.where("v > 5")
    assert rows(FI.not_in(left, "a", with_null, "v")) == []
    assert rows(FI.not_in(left, "a", known, "v")) == [(2,)]
    assert rows(FI.not_in(left, "a", empty, "v")) == [(1,), (2,), (None,)]


def test_optional_filter_forms_differ_on_null(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, x string")
    assert rows(FI.optional_filters(df, x=None).select("id")) == [(1,), (2,)]
    assert rows(FI.optional_filters_coalesced(df, x=None).select("id")) == [(1,)]


def test_literal_prefix(spark, rows):
    df = spark.createDataFrame([("[OT] a",), ("[OT] b",), ("O c",), ("50% off",), ("500 km",)], "s string")
    assert len(rows(df.where(FI.starts_with_text("s", "[OT]")))) == 2
    assert rows(df.where(FI.starts_with_text("s", "50%"))) == [("50% off",)]


def test_single_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    one = spark.range(1)
    assert one.select(FI.single_value(df.where("k = 2"), "v")).first()[0] == "c"
    assert one.select(FI.single_value(df.where("k = 9"), "v")).first()[0] is None
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        one.select(FI.single_value(df.where("k = 1"), "v")).collect()


def test_ranks_of_quantities(spark, rows):
    qty = [10, 10, 10, 10, 15, 20, 20, 20, 30, 30, 40]
    df = spark.createDataFrame(list(enumerate(qty)), "id int, qty int")
    ranked = O.with_ranks(df, [], ["qty"], rank="r", dense_rank="d").select("qty", "r", "d").distinct()
    assert rows(ranked) == [(10, 1, 1), (15, 5, 2), (20, 6, 3), (30, 9, 4), (40, 11, 5)]


def test_running_balance(spark):
    values = [4, -2, 5, 2, 1, 3, -4, -1, -2, -3]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "acc int, id int, val bigint")
    out = O.running(df, ["acc"], ["id"], balance=("sum", F.col("val"))).orderBy("id")
    assert [r.balance for r in out.collect()] == [4, 2, 7, 9, 10, 13, 9, 8, 6, 3]


def test_asof_strict_and_inclusive(spark, rows):
    left = spark.createDataFrame([("a", 5, 1), ("a", 9, 2), ("b", 1, 3)], "k string, at int, id int")
    right = spark.createDataFrame([("a", 4, 10), ("a", 5, 11)], "k string, at int, id int")
    strict = J.asof_join(left, right, ["k"], "at", "id", ["id"]).select("id", "prior_id")
    loose = J.asof_join(left, right, ["k"], "at", "id", ["id"], strict=False).select("id", "prior_id")
    assert rows(strict) == [(1, 10), (2, 11), (3, None)]
    assert rows(loose) == [(1, 11), (2, 11), (3, None)]


def test_divide(spark, rows):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("z", 1), ("z", 2), ("z", 3)], "k string, m int")
    wanted = spark.createDataFrame([(1,), (2,)], "m int")
    assert rows(J.divide(df, "k", "m", wanted)) == [("x",), ("z",)]
    assert rows(J.divide(df, "k", "m", wanted, all_if_empty=True)) == [("x",), ("z",)]
    assert rows(J.divide(df, "k", "m", wanted.where("m > 5"))) == []
    assert rows(J.divide(df, "k", "m", wanted.where("m > 5"), all_if_empty=True)) == [("x",), ("y",), ("z",)]


def test_group_by_all_keeps_empty_groups(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 9)], "k string, v int")
    out = A.group_by_all(df, ["k"], F.col("v") > 5, n=("count", F.col("v")), s=("sum", F.col("v")))
    assert rows(out) == [("a", 0, None), ("b", 1, 9)]


def test_unpivot_families_keeps_half_known_rows(spark, rows):
    df = spark.createDataFrame([("c", 1, None, None, 5.0)], "k string, q1 int, q2 int, v1 double, v2 double")
    out = P.unpivot_families(df, ["k"], [1, 2], {"q": ["q1", "q2"], "v": ["v1", "v2"]}, "y")
    assert rows(out) == [("c", 1, 1, None), ("c", 2, None, 5.0)]
    none = spark.createDataFrame([("c", None, None)], "k string, q1 int, v1 double")
    assert rows(P.unpivot_families(none, ["k"], [1], {"q": ["q1"], "v": ["v1"]}, "y")) == []


def test_unpivot_drops_nulls_unless_asked(spark):
    df = spark.createDataFrame([(1, 5, None)], "k int, a int, b int")
    assert P.unpivot(df, ["k"], ["a", "b"], "n", "v").count() == 1
    assert P.unpivot(df, ["k"], ["a", "b"], "n", "v", keep_nulls=True).count() == 2


def test_pivot_dynamic_refuses_unknown_aggregates(spark):
    with pytest.raises(ValueError):
        P.pivot_dynamic(spark.range(1), ["id"], "id", "median", "id")


def test_table_diff_counts_duplicates(spark, rows):
    old = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    new = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    assert rows(U.table_diff(old, new)) == [(2, "x", "old"), (3, "y", "new")]


def test_text_functions(spark):
    df = spark.createDataFrame([("ab  ", "a]b", "abcdef")], "s string, q string, t string")
    out = df.select(X.length_trimmed(F.col("s")), X.quote_name(F.col("q")), X.stuff(F.col("t"), 2, 3, "XY")).first()
    assert tuple(out) == (2, "[a]]b]", "aXYef")


def test_split_keeps_or_skips_empty(spark, rows):
    df = spark.createDataFrame([("A", "20,,7")], "id string, arr string")
    assert rows(X.split_to_rows(df, "arr", ",", True)) == [("A", 1, "20"), ("A", 2, ""), ("A", 3, "7")]
    assert rows(X.split_to_rows(df, "arr", ",", False)) == [("A", 1, "20"), ("A", 2, "7")]


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 1))], "a date, b date, fri date")
    row = df.select(
        D.months_crossed(F.col("a"), F.col("b")),
        D.friday_on_or_before(F.col("fri")),
        D.friday_before(F.col("fri")),
        D.end_of_year(F.col("a")),
    ).first()
    assert tuple(row) == (1, dt.date(2024, 3, 1), dt.date(2024, 2, 23), dt.date(2024, 12, 31))


def test_masks(spark):
    df = spark.createDataFrame([("CEO Top Boss", "x", None)], "a string, b string, c string")
    row = df.select(
        K.mask_partial(F.col("a"), 2, "XXXXXXXX", 1),
        K.mask_partial(F.col("b"), 2, "XXXXXXXX", 1),
        K.mask_default(df, "c"),
        K.mask_email(F.col("a")),
    ).first()
    assert tuple(row) == ("CEXXXXXXXXs", "XXXXXXXX", None, "CXXX@XXXX.com")


def test_json(spark, rows):
    docs = [('{"id": 1}',), ("[1]",), ("7",), ('"t"',), ("{broken",), (None,)]
    df = spark.createDataFrame(docs, "d string")
    assert [r[0] for r in df.select(JS.is_json(F.col("d"))).collect()] == [1, 1, 0, 0, 0, None]
    good = spark.createDataFrame(docs[:1], "d string")
    assert good.select(JS.strict_value(F.col("d"), "$.id")).first()[0] == "1"
    with pytest.raises(Exception, match="no .* in"):
        good.select(JS.strict_value(F.col("d"), "$.name")).collect()


def test_left_outer_join_keeps_null_and_unmatched_keys(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "r int, y int")
    out = J.left_outer_join(left, right, "k", "r").select("x", "y")
    assert rows(out) == [("a", 10), ("a", 11), ("b", None), ("c", None)]
    assert rows(out) == rows(left.join(right, F.col("k") == F.col("r"), "left").select("x", "y"))


@pytest.mark.parametrize("sep", [".", "|", "*", "\\E", ", "])
def test_separators_are_plain_text(spark, rows, sep):
    df = spark.createDataFrame([("A", sep.join(["a.b", "", "c"]) if sep != "." else "a..c")], "k string, arr string")
    found = [r[2] for r in rows(X.split_to_rows(df, "arr", sep, True))]
    assert found == (["a", "", "c"] if sep == "." else ["a.b", "", "c"])


def test_only_a_percent_sign_makes_a_pattern(spark, rows):
    df = spark.createDataFrame([("A_1",), ("AB1",)], "x string")
    assert rows(df.where(FI.like_or_equal("x", "A_1"))) == [("A_1",)]
    assert rows(df.where(FI.like_or_equal("x", "A_%"))) == [("AB1",), ("A_1",)]


@pytest.mark.parametrize(
    "doc, path, wanted",
    [
        ('{"k":1,"s":"x","n":{"a":1},"d":1.5}', "$.k", '{"k":"v","s":"x","n":{"a":1},"d":1.5}'),
        ('{"info":{"address":{"town":"o","z":[1,{"q":2}]}},"t":null,"b":true}', "$.info.address.town",
         '{"info":{"address":{"town":"v","z":[1,{"q":2}]}},"t":null,"b":true}'),
        ("{}", "$.a.b", '{"a":{"b":"v"}}'),
        ('{"a":5,"s":"1"}', "$.a.b", '{"a":{"b":"v"},"s":"1"}'),
        (None, "$.a", None), ("[1]", "$.a", None), ("no", "$.a", None),
        ('{"a":1,"b":[1,"2",null]}', "$.b[1]", '{"a":1,"b":[1,"v",null]}'),
        ('{"b":[1,"2"]}', "$.b[2]", '{"b":[1,"2","v"]}'), ('{"b":[1]}', "$.b[5]", '{"b":[1]}'),
        ('{"a":1}', "$.b[0]", '{"a":1}'), ('{"b":7}', "$.b[0]", '{"b":7}'),
        ('{"r":[[1,2],[3,{"x":4}]]}', "$.r[1][1].x", '{"r":[[1,2],[3,{"x":"v"}]]}'),
        ('{"r":[{"y":1}]}', "$.r[0].x.z", '{"r":[{"y":1,"x":{"z":"v"}}]}'), ('{"r":[1]}', "$.r[0].x", '{"r":[1]}'),
    ],
)
def test_json_member_is_set_by_path(spark, doc, path, wanted):
    df = spark.createDataFrame([(doc,)], "s string")
    assert df.select(JS.set_value(F.col("s"), path, F.lit("v"))).first()[0] == wanted


def test_json_member_set_to_null_is_json(spark):
    docs = ['{"a":1,"b":[1,2]}', "{}", '{"a":{"x":"y"}}']
    df = spark.createDataFrame([(d,) for d in docs], "s string")
    for value in (F.lit(None), F.lit(None).cast("int"), F.lit(None).cast("string")):
        found = [r[0] for r in df.select(JS.set_value(F.col("s"), "$.a", value)).collect()]
        assert found == ['{"a":null,"b":[1,2]}', '{"a":null}', '{"a":null}']
    assert df.select(JS.set_value(F.col("s"), "$.b[0]", F.lit(None))).first()[0] == '{"a":1,"b":[null,2]}'
    with pytest.raises(ValueError, match="not a member path"):
        JS.set_value(F.col("s"), "$.b[x]y", F.lit(1))


INTERVALS = {
    "number": ("double", lambda n: n / 4),
    "date": ("date", lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)),
    "timestamp": ("timestamp", lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n * 977)),
    "clock": ("timestamp_ntz", lambda n: dt.datetime(1969, 12, 31, 23) + dt.timedelta(seconds=n / 2)),
}


@pytest.mark.parametrize("kind", INTERVALS)
@pytest.mark.parametrize("closed", [True, False])
def test_overlapping_intervals(spark, rows, kind, closed):
    """Lengths from nothing to nearly everything, reversed and open ends, hot keys."""
    draw, (ddl, make) = random.Random(7), INTERVALS[kind]

    def side(n, first):
        out = []
        for i in range(n):
            start = draw.randint(-500, 500)
            length = draw.choice([0, 1, 1, 3, 10, 10, 60, 900, -5])
            ends = [make(start), make(start + length)]
            if draw.random() < 0.05:
                ends[draw.randint(0, 1)] = None
            out.append((first + i, draw.choice(["hot", "hot", "x", None]), *ends))
        return out

    a, b = side(120, 0), side(90, 1000)
    left = spark.createDataFrame(a, f"i int, k string, a0 {ddl}, a1 {ddl}")
    right = spark.createDataFrame(b, f"j int, k string, b0 {ddl}, b1 {ddl}")

    def meet(p, q, keyed=True):
        if None in (p[2], p[3], q[2], q[3]) or keyed and (p[1] is None or p[1] != q[1]) or p[2] > p[3] or q[2] > q[3]:
            return False
        if closed:
            return p[2] <= q[3] and q[2] <= p[3]
        return p[2] < q[3] and q[2] < p[3] and p[2] < p[3] and q[2] < q[3]

    for width in (None, 5, 100_000):
        found = J.overlapping(left, right, ("a0", "a1"), ("b0", "b1"), ["k"], closed, width)
        assert found.columns == ["i", "k", "a0", "a1", "j", "b0", "b1"]
        assert rows(found.select("i", "j")) == sorted(((p[0], q[0]) for p in a for q in b if meet(p, q)), key=repr)
    found = J.overlapping(left.drop("k"), right.drop("k"), ("a0", "a1"), ("b0", "b1"), closed=closed)
    assert rows(found.select("i", "j")) == sorted(((p[0], q[0]) for p in a for q in b if meet(p, q, False)), key=repr)
    points = J.points_in_intervals(left, right, "a0", "b0", "b1", ["k"], closed)
    inside = lambda p, q: meet((0, p[1], p[2], p[2]), q) if closed else (
        None not in (p[1], p[2], q[2], q[3]) and p[1] == q[1] and q[2] <= p[2] < q[3])
    assert rows(points.select("i", "j")) == sorted(((p[0], q[0]) for p in a for q in b if inside(p, q)), key=repr)


def test_overlapping_nothing(spark):
    left, right = spark.createDataFrame([], "a0 int, a1 int"), spark.createDataFrame([(1, 2)], "b0 int, b1 int")
    assert J.overlapping(left, right, ("a0", "a1"), ("b0", "b1")).count() == 0
    assert J.overlapping(right, left, ("b0", "b1"), ("a0", "a1")).count() == 0


def test_orders_keep_all_their_lines(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    counted = order_xml(order_lines(lines)).select(F.size(F.split("doc", "<OrderDetail ")) - 1).toPandas()
    assert counted.iloc[:, 0].sum() == lines.count()


def test_diff_counts_copies(spark, rows):
    old = spark.createDataFrame([(1,), (1,), (1,), (None,)], "x int")
    new = spark.createDataFrame([(1,), (2,), (2,), (None,)], "x int")
    assert rows(U.table_diff(old, new)) == [(1, "old"), (1, "old"), (2, "new"), (2, "new")]


def test_rows_at_the_maximum_keep_ties(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", None), (None, 2), (None, 2)], "k string, v int")
    assert rows(FI.rows_at_maximum(df, ["k"], "v")) == [("a", 3), ("a", 3), (None, 2), (None, 2)]


def test_id_lists_of_three_kinds(spark, rows):
    df = spark.range(5)
    assert rows(J.id_list(spark, "[3, 1]")) == rows(J.id_list(spark, "3,1")) == [(1, 3), (2, 1)]
    table = spark.range(3, 9).select(F.lit(1).alias("pos"), "id")
    assert rows(J.join_id_list(df.toDF("n"), "n", table)) == [(3, 1), (4, 1)]


def test_edges_keep_their_attributes(spark, rows):
    nodes = spark.createDataFrame([(10, "x"), (11, "y")], "node_id int, name string")
    pairs = spark.createDataFrame([("x", "y", 5)], "a string, b string, rating int")
    found = G.edges_from_keys(pairs, nodes.toDF("node_id", "a"), nodes.toDF("node_id", "b"), "a", "b", ["rating"])
    assert rows(found) == [(10, 11, 5)]
