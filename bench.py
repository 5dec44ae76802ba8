"""Headline queries, timed; prints one JSON line.

``q`` entries run registered queries on $BENCH_SF_DIR. ``t2m_`` entries time the
from lineitem (100 accounts, lines repeated) and stored before timing starts. ``skew_``
entries run some of them on five million rows of which one account has 80 %, sliced and
(``_plain``) in one task; ``merge_`` entries apply a change set to that table by key.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.operators import changes as M  # noqa: E402
from millrace.operators import windows as V  # noqa: E402
from millrace.plans import ordered as O  # noqa: E402
from millrace.registry import all_queries  # noqa: E402
from millrace.session import local_session  # noqa: E402
from millrace.sources.tables import Tables, materialise  # noqa: E402

HEADLINE = """
scan_range_pruned partitioned_write multiway_join star_join_agg interval_join asof_prior_lookup lateral_topn
relational_division match_cycle subtree multi_count_distinct nested_aggregate_argmax cube pivot_dynamic
unpivot_multi_measure array_aggregate_json running_total_rows running_total_range moving_avg_rows moving_max_rows
offset_frame rank_dense_rank ntile percentile_window padded_calendar_window gaps islands_dupes
islands_with_tolerance top_n_per_group table_diff fn_split_to_rows json_explode_typed text_contains_terms
xml_attribute_shred merge_upsert merge_by_source change_log balance_rule temporal_join_as_of temporal_write
counter_deltas nonequi_self_join
""".split()

ROWS, SKEW_ROWS = 2_000_000, 5_000_000
KEY, ORDER = ["actid"], ["tranid"]


def accounts(t: Tables) -> DataFrame:
    copies = math.ceil(ROWS / t.lineitem.count())
    lines = t.lineitem.select(
        F.pmod("l_suppkey", F.lit(100)).alias("actid"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("val"),
        F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"),
    )
    numbered = lines.withColumn("tranid", F.monotonically_increasing_id()).drop("copy")
    return materialise(numbered, "bench-accounts")


def window_forms(a: DataFrame) -> dict:
    val = F.col("val")

    def two_directions():
        return O.with_group_totals(O.number_rows(a, KEY, ORDER, "up"), KEY, n=F.count(F.lit(1))).withColumn(
            "down", F.col("n") - F.col("up") + 1
        )

    maxed = lambda: O.with_group_totals(a, KEY, mx=F.max("val"))
    return {
        "row_number_both": two_directions,
        "partition_max": maxed,
        "partition_max_filter": lambda: maxed().where(val == F.col("mx")),
        "running_sum_rows": lambda: O.running(a, KEY, ORDER, s=("sum", val)),
        "running_sum_range": lambda: V.running_with_ties(a, KEY, "tranid", "s", "val"),
        "sum_5_to_2": lambda: O.row_frames(a, KEY, ORDER, s=(-5, -2, F.sum("val"))),
        "max_100_to_2": lambda: O.row_frames(a, KEY, ORDER, s=(-100, -2, F.max("val"))),
        "sum_100_to_2": lambda: O.moving_sums(a, KEY, ORDER, s=(-100, -2, val)),
        "max_single_9999": lambda: O.row_frames(a, KEY, ORDER, s=(-9999, -9999, F.max("val"))),
        "max_single_10000": lambda: O.row_frames(a, KEY, ORDER, s=(-10000, -10000, F.max("val"))),
    }


def skewed(t: Tables) -> DataFrame:
    """One account with 80 % of at least five million rows."""
    copies = math.ceil(SKEW_ROWS / t.lineitem.count())
    key = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "copy"), F.lit(500))
    lines = t.lineitem.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")).select(
        F.when(key < 400, 0).otherwise(key - 399).alias("actid"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("val"),
    )
    return materialise(lines.withColumn("tranid", F.monotonically_increasing_id()), "bench-skewed")


def skew_forms(a: DataFrame) -> dict:
    val = F.col("val")
    forms = {
        "row_number": lambda: O.number_rows(a, KEY, ORDER),
        "running_sum": lambda: O.running(a, KEY, ORDER, s=("sum", val)),
        "max_100_to_2": lambda: O.row_frames(a, KEY, ORDER, s=(-100, -2, F.max("val"))),
    }

    changes = a.where(F.pmod("tranid", F.lit(50)) == 0).select(
        "tranid", "actid", (val + 1).cast("decimal(18,2)").alias("val")
    )
    upsert = lambda: M.upsert(a, changes, ["tranid"])
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    return (
        {f"skew_{n}": (build, {}) for n, build in forms.items()}
        | {f"skew_{n}_plain": (build, {O.HOT_ROWS_CONF: str(1 << 40)}) for n, build in forms.items()}
        | {"merge_broadcast": (upsert, {threshold: "200m"}), "merge_shuffled": (upsert, {threshold: "-1"})}
    )


def timed(build, spark=None, conf: dict | None = None) -> float:
    for name, value in (conf or {}).items():
        spark.conf.set(name, value)
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    took = round(time.perf_counter() - started, 3)
    for name in conf or {}:
        spark.conf.unset(name)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, sf_dir)
    registered = all_queries()
    timed(lambda: registered["star_join_agg"](spark, sf_dir))  # warm-up
    times = {key: timed(lambda k=key: registered[k](spark, sf_dir)) for key in HEADLINE}
    table = accounts(t)
    times |= {f"t2m_{name}": timed(build) for name, build in window_forms(table).items()}
    times |= {name: timed(build, spark, conf) for name, (build, conf) in skew_forms(skewed(t)).items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "t2m_rows": table.count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
