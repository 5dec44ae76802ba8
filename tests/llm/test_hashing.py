"""Bit tables of hashes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.hashing import FILTER_BITS, bit_table, held


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_bit_tables_reach_the_driver_without_an_object_for_each_row(spark, monkeypatch, rows):
    keys = spark.range(rows).select(F.xxhash64("id").alias("h")).cache()
    hashes = np.array([r["h"] for r in keys.collect()], "int64")

    def refused(*_):
        raise AssertionError("rows as Python objects")

    for name in ("toPandas", "collect", "toLocalIterator"):
        monkeypatch.setattr(type(keys), name, refused)
    table = bit_table(keys, F.col("h"))
    bits = np.unique(hashes % FILTER_BITS)
    assert held(table, hashes).all()
    assert int(np.bitwise_count(table).sum()) == len(bits)
