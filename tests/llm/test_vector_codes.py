"""Vector codes against plain loops over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.vector_codes import books_digest, compress, nearest_by_sum

SCHEMA = "vec_id long, embedding array<float>, label int"


def nearest(x, book):
    gaps = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
    return gaps.index(min(gaps)), min(gaps)


def plain(rows, parts, entries, rounds, scale):
    kept = [(d, [math.floor(scale * x) for x in v], label) for d, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            met = [[] for _ in books[p]]
            for _, v, _ in kept:
                met[nearest(cut(v, p), books[p])[0]].append(cut(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(met, books[p])]
    out = []
    for d, v, label in kept:
        near = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((d, label, "".join(f"{k:02x}" for k, _ in near), sum(e for _, e in near)))
    total = {}
    for _, label, _, e in out:
        total[label] = total.get(label, 0) + e
    return sorted(((*r, total[r[1]]) for r in out), key=repr), books


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("v", "p", "k", "code", "error", "total"):
        df = df.withColumn(clash, F.lit("x"))
    found, books = compress(df.repartition(3), **options)
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]
    return sorted((tuple(r) for r in found.collect()), key=repr), books


def test_equals_plain_loops(spark):
    draw = random.Random(1)
    vector = lambda: [draw.choice([-0.5, 0.25, draw.gauss(0, 1)]) for _ in range(6)]
    rows = [(i, np.float32(vector()).tolist(), draw.choice([None, 1, 1, 1, 2])) for i in range(150)]
    rows += [(3, rows[3][1], 1), (3, rows[4][1], 7), (None, rows[5][1], 2)]  # a repeated row, a repeated id, no id
    rows += [(200, None, 1), (201, [float("nan")] * 6, 1), (202, [None] + [0.5] * 5, 1), (-1, [float("inf")] * 6, 2)]
    options = {"parts": 3, "entries": 5, "rounds": 4, "scale": 16}
    wanted, books = plain(rows, **options)
    found, made = coded(spark, rows, **options)
    assert made == books and found == wanted
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert books_digest(made) == hashlib.sha256(text.encode()).hexdigest()


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(2, [1.0, 2.0], None), (1, [1.0, 2.0], None)]
    found, books = coded(spark, rows, parts=2, entries=4, rounds=2, scale=2)
    assert books == [[[2], [2]], [[4], [4]]]
    assert found == [(1, None, "0000", 0, 0), (2, None, "0000", 0, 0)]
    assert coded(spark, [(1, None, 3)]) == ([], []) and coded(spark, []) == ([], [])


def test_other_lengths(spark):
    found, _ = coded(spark, [(1, [1.0, 2.0], 1), (2, [1.0], 1), (3, [], 1)], parts=2, entries=4, rounds=1)
    assert [r[0] for r in found] == [1]
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [1.0, 2.0, 3.0], 1)], parts=2)


@pytest.mark.parametrize("span", [3, 1_000, 1 << 40])
def test_nearest_entry(span):
    draw = np.random.default_rng(span)
    for width, entries in ((1, 1), (4, 16), (8, 40)):
        x, book = draw.integers(-span, span, (200, width)), draw.integers(-span, span, (entries, width))
        book[-1] = book[0]
        found, gaps = nearest_by_sum(x, book)
        for row, k, gap in zip(x.tolist(), found.tolist(), gaps.tolist()):
            assert (k, gap) == nearest(row, book.tolist())
