"""Word search through the stored index, against plain Python and the scan of texts."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import contains_word
from millrace.operators.setops import table_diff
from millrace.operators.text_index import build_index, search_index
from millrace.sources.tables import work_path

TEXTS = [
    (1, "Rock and roll, rock-steady"), (2, "rocking chair"), (3, None), (4, ""), (5, "STEADY state"),
    (6, "état stable; l'état"), (7, "rock"), (7, "chair"), (8, "123 ... 456"), (9, "roll " * 50_000 + "end"), (None, "rock"),
]
SEARCHES = {
    "one": [["rock"]], "either": [["rock", "STATE"]], "both": [["rock"], ["steady", "chair"]],
    "prefix": [["rock*"]], "accent": [["état"]], "nothing": [["absent"]], "no_terms": [[]], "long": [["roll"], ["end"]],
}


@pytest.fixture(scope="module")
def index(spark):
    path = work_path(spark, "index-test")
    build_index(spark.createDataFrame(TEXTS, "n int, body string"), "n", "body", path)
    return path


def test_searches_against_plain_python(spark, index, rows):
    words = {}
    for n, body in TEXTS:
        words.setdefault(n, set()).update(re.findall(r"[^\W\d_]+", (body or "").lower()))
    fits = lambda term, have: any(w.startswith(term[:-1].lower()) if term.endswith("*") else w == term.lower() for w in have)
    wanted = [
        (name, n) for name, clauses in SEARCHES.items() for n, have in words.items()
        if all(any(fits(term, have) for term in some) for some in clauses)
    ]
    assert rows(search_index(spark, index, SEARCHES)) == sorted(wanted, key=repr)


def test_same_rows_as_the_scan(spark, rows, tmp_path):
    docs = spark.createDataFrame([(i, body) for i, (_, body) in enumerate(TEXTS)], "n int, body string")
    build_index(docs, "n", "body", work_path(spark, "index-scan"))
    path = work_path(spark, "index-scan")
    build_index(docs, "n", "body", path)
    found = search_index(spark, path, {"s": [["rock", "chair"]]}).select("id")
    assert rows(found) == rows(docs.where(contains_word(F.col("body"), "rock", "chair")).select("n"))


def test_words_reach_the_scan(spark, index):
    plan = search_index(spark, index, {"s": [["rock"]]})._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*(EqualTo|In)\(word", plan)


def test_empty_table_and_refused_searches(spark, rows):
    path = work_path(spark, "index-empty")
    build_index(spark.createDataFrame([], "n int, body string"), "n", "body", path)
    assert rows(search_index(spark, path, {"s": [["rock"]]})) == []
    with pytest.raises(ValueError, match="clauses"):
        search_index(spark, path, {"s": []})


def test_diff_counts_copies_beyond_one_piece(spark):
    old = spark.range(70_000).select(F.lit(1).alias("k"), F.lit(None).cast("string").alias("v"))
    new = old.limit(2).unionByName(spark.createDataFrame([(2, "x")] * 3, "k int, v string"))
    sides = {(r["k"], r["side"]): r["count"] for r in table_diff(old, new).groupBy("k", "side").count().collect()}
    assert sides == {(1, "old"): 69_998, (2, "new"): 3}


def test_diff_of_equal_tables_is_empty(spark):
    same = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, v string")
    assert table_diff(same, same.repartition(3)).isEmpty()
    assert table_diff(same, same).columns == ["k", "v", "side"]
