"""One key holds more than half of the rows; results against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows as V
from millrace.plans import ordered as O

ROWS = 400


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    rows = []
    for i in range(ROWS):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        rows.append((key, i, rng.randint(0, 9), rng.randint(-5, 5)))
    # A third of the hot key shares one order value.
    return [(k, i, 4 if k == "hot" and i % 3 == 0 else o, v) for k, i, o, v in rows]


@pytest.fixture
def df(spark, data, tiny_tasks):
    return spark.createDataFrame(data, "k string, id int, o int, v bigint").repartition(5)


def grouped(data):
    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    return {k: sorted(g, key=lambda r: (r[2], r[1])) for k, g in groups.items()}


def collect(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_running(df, data):
    out = collect(O.running(df, ["k"], ["o", "id"], s=("sum", F.col("v")), n=("count", F.lit(1)), m=("max", F.col("v"))), "s", "n", "m")
    for g in grouped(data).values():
        seen = []
        for r in g:
            seen.append(r[3])
            assert out[r[1]] == (sum(seen), len(seen), max(seen))
    assert len(out) == ROWS


def test_running_without_keys(df, data):
    out = collect(O.running(df, [], ["o", "id"], s=("sum", F.col("v"))), "s")
    total = 0
    for r in sorted(data, key=lambda r: (r[2], r[1])):
        total += r[3]
        assert out[r[1]] == (total,)


def test_neighbours(df, data):
    out = collect(O.neighbours(df, ["k"], ["o", "id"], previous={"p": "id"}, following={"f": "id"}), "p", "f")
    for g in grouped(data).values():
        ids = [None, *[r[1] for r in g], None]
        for p, i, f in zip(ids, ids[1:], ids[2:]):
            assert out[i] == (p, f)


def test_row_frames(df, data):
    out = collect(
        O.row_frames(df, ["k"], ["o", "id"], a=(-30, -2, F.sum("v")), b=(-1, 3, F.max("v")), c=(-25, -25, F.max("v"))), "a", "b", "c"
    )
    for g in grouped(data).values():
        v = [r[3] for r in g]
        for j, r in enumerate(g):
            before = v[max(0, j - 30) : max(0, j - 1)]
            assert out[r[1]] == (
                sum(before) if before else None,
                max(v[max(0, j - 1) : j + 4]),
                v[j - 25] if j >= 25 else None,
            )
    assert len(out) == ROWS


def test_moving_sums(df, data):
    out = collect(O.moving_sums(df, ["k"], ["o", "id"], a=(-6, 0, F.col("v")), b=(-6, -2, F.col("v"))), "a", "b")
    for g in grouped(data).values():
        v = [r[3] for r in g]
        for j, r in enumerate(g):
            before = v[max(0, j - 6) : max(0, j - 1)]
            assert out[r[1]] == (sum(v[max(0, j - 6) : j + 1]), sum(before) if before else None)


def test_ranks(df, data):
    out = collect(O.with_ranks(df, ["k"], ["o"], rank="r", dense_rank="d", percent_rank="p", cume_dist="c"), "r", "d", "p", "c")
    for g in grouped(data).values():
        orders = [r[2] for r in g]
        for r in g:
            below = sum(x < r[2] for x in orders)
            upto = sum(x <= r[2] for x in orders)
            rank, dense, pct, cume = out[r[1]]
            assert (rank, dense) == (below + 1, len({x for x in orders if x <= r[2]}))
            assert pct == pytest.approx(below / (len(g) - 1))
            assert cume == pytest.approx(upto / len(g))


def test_ntile(df, data):
    out = collect(V.with_ntile(df, ["k"], ["o", "id"], t=7), "t")
    for g in grouped(data).values():
        small, large = divmod(len(g), 7)
        sizes = [small + (i < large) for i in range(7)]
        expected = [i + 1 for i, size in enumerate(sizes) for _ in range(size)]
        assert [out[r[1]][0] for r in g] == expected


def test_running_with_ties(df, data):
    out = collect(V.running_with_ties(df, ["k"], "o", "s", "v"), "s")
    for g in grouped(data).values():
        for r in g:
            assert out[r[1]] == (sum(x[3] for x in g if x[2] <= r[2]),)


def test_percentiles(df, data, spark):
    out = {r.k: (r.d, r.c) for r in O.group_percentiles(df, ["k"], "v", d=("disc", 0.5), c=("cont", 0.3)).collect()}
    for k, g in grouped(data).items():
        v = sorted(r[3] for r in g)
        disc = v[-(-len(v) // 2) - 1]
        at = 0.3 * (len(v) - 1)
        low, high = v[int(at)], v[min(int(at) + 1, len(v) - 1)]
        cont = low + (high - low) * (at - int(at))
        assert out[k] == (disc, pytest.approx(cont))


def test_slices_are_balanced(df):
    hot = df.where("k = 'hot'")
    sizes = [r["count"] for r in O.with_slices(hot, ["k"], ["o", "id"]).groupBy("_slice").count().collect()]
    assert len(sizes) > 5
    assert max(sizes) < 0.4 * hot.count()


D = "decimal(18,2)"
BOTH_PLANS = {
    "running": lambda d: O.running(d, ["k"], ["o", "id"], s=("sum", F.col("v").cast(D)), i=("sum", F.col("v").cast("int")), n=("count", F.lit(1)), m=("min", F.col("v").cast(D))),
    "running_no_keys": lambda d: O.running(d, [], ["o", "id"], s=("sum", F.col("v").cast(D))),
    "number_rows": lambda d: O.number_rows(d, ["k"], ["o", "id"]),
    "neighbours": lambda d: O.neighbours(d, ["k"], ["o", "id"], previous={"p": "v"}, following={"f": "o"}),
    "row_frames": lambda d: O.row_frames(d, ["k"], ["o", "id"], a=(-2, 1, F.avg(F.col("v").cast(D))), s=(-3, 0, F.sum(F.col("v").cast(D)))),
    "moving_sums": lambda d: O.moving_sums(d, ["k"], ["o", "id"], s=(-3, -1, F.col("v").cast(D))),
    "with_ranks": lambda d: O.with_ranks(d, ["k"], ["o"], rank="r", dense_rank="d", percent_rank="p", cume_dist="c"),
    "percentiles": lambda d: O.group_percentiles(d, ["k"], "v", m=("cont", 0.5), q=("disc", 0.25)),
    "with_ties": lambda d: V.running_with_ties(d.withColumn("w", F.col("v").cast(D)), ["k"], "o", "s", "w"),
    "with_ntile": lambda d: V.with_ntile(d, ["k"], ["o", "id"], t=3),
    "group_totals": lambda d: O.with_group_totals(d, ["k"], s=F.sum(F.col("v").cast(D))),
}


@pytest.mark.parametrize("name", BOTH_PLANS)
def test_both_plans_give_the_same_columns_types_and_rows(spark, data, rows, name):
    df = spark.createDataFrame(data, "k string, id int, o int, v bigint")
    plain = BOTH_PLANS[name](df)
    dtypes, found = plain.dtypes, rows(plain)
    spark.conf.set(O.HOT_ROWS_CONF, "20")
    try:
        sliced = BOTH_PLANS[name](df)
        assert sliced.dtypes == dtypes and rows(sliced) == found
        spark.conf.set(O.SLICES_CONF, "4")  # fewer and larger slices
        assert rows(BOTH_PLANS[name](df)) == found
    finally:
        spark.conf.unset(O.HOT_ROWS_CONF)
        spark.conf.unset(O.SLICES_CONF)


def test_moving_sums_of_unknown_values(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None), (4, 1)], "id int, v int")
    out = O.moving_sums(df, [], ["id"], s=(-1, 0, F.col("v")))
    assert rows(out.select("id", "s")) == [(1, 5), (2, 5), (3, None), (4, 1)]
