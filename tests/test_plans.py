"""What the plans must and must not contain, with automatic broadcasts off as for
large tables."""

import pytest

from millrace.plans.ordered import HOT_ROWS_CONF
from millrace.registry import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
WRITING = ("stream", "partition", "insert_s", "create_t", "subtree", "order_insert", "json_computed", "json_rowset", "padded")


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def plan(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


JOINING = ("filters", "joins", "graph", "aggregates", "changes", "quality", "temporal", "monitoring")
CHECKED = [
    k
    for k, q in QUERIES.items()
    if q.build.__module__.endswith(JOINING) and not k.startswith(WRITING) and k != "cross_join"
]


@pytest.mark.parametrize("key", CHECKED)
def test_no_products(spark, no_broadcast, key):
    text = plan(spark, key)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", ["top_n_per_group", "lateral_topn", "outer_lateral_topn", "udf_inline_table", "nested_aggregate_argmax"])
def test_groups_are_cut_before_the_shuffle(spark, key):
    assert plan(spark, key).count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "key, pushed",
    [
        ("scan_range_pruned", "GreaterThan(l_shipdate"),
        ("scan_string_pushdown", "EqualTo(p_brand"),
        ("date_halfopen_range", "GreaterThanOrEqual(ts"),
        ("like_prefix", "StringStartsWith(p_name"),
        ("parameterized_query", "GreaterThan(o_totalprice"),
        ("optional_filters", "EqualTo(o_orderstatus"),
        ("temporal_as_of", "GreaterThan(valid_to"),
        ("temporal_as_of", "LessThanOrEqual(valid_from"),
        ("temporal_between", "GreaterThan(valid_to"),
    ],
)
def test_filters_reach_the_scan(spark, key, pushed):
    assert pushed in plan(spark, key)


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "running_total_rows")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text


def test_sliced_window_shuffles_the_rows_once(spark, no_broadcast):
    """Rows are exchanged by group once; the other exchanges carry summaries."""
    spark.conf.set(HOT_ROWS_CONF, "100")
    try:
        text = plan(spark, "row_number_arbitrary")
    finally:
        spark.conf.unset(HOT_ROWS_CONF)
    assert text.count("SortMergeJoin") == 1
    rows_side = text[text.index("SortMergeJoin") :].splitlines()[1:5]
    assert [any(x in line for line in rows_side) for x in ("Window", "Sort [_group", "Exchange hashpartitioning(_group")] == [True] * 3
