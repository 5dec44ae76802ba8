"""Near duplicates with long lists: blocks, pairs of blocks, pivots in place of sets."""

import random

import numpy as np
import pytest
from test_operators import components_of, documents, tuples

from millrace.llm import jaccard
from millrace.llm.jaccard import _may_link, block_pairs, jaccard_components, read_lists


@pytest.mark.parametrize("block", [1, 3, 16])
def test_lists_give_all_pairs_that_may_link(spark, block):
    """Entries of a common token, of some shared ones and of tokens of their own."""
    rnd = random.Random(block)
    rows = set()
    for p in range(120):
        size, comp = rnd.choice([8, 9, 10, 12, 40, 41, 400]), rnd.choice([p, 7, 7])
        sketch = rnd.choice([0, 1, 0xFF, -1]), rnd.choice([0, -2])
        for token in {5, rnd.randrange(-4, 4), 10_000 + p}:
            rows.add((token, size, rnd.randrange(0, 1 + size // 4), p, comp, *sketch))
    packed = [(t, size << 32 | place, *others) for t, size, place, *others in sorted(rows)]
    df = spark.createDataFrame(packed, "token long, rank long, pivot long, comp long, s0 long, s1 long").repartition(3, "token")
    lists = read_lists(df.sortWithinPartitions("token", "rank", "pivot"), block).cache()
    pairs = lists.where("a IS NOT NULL").select("a", "b").unionByName(block_pairs(lists.where("a IS NULL").drop("a", "b")))
    found = {tuple(r) for r in pairs.collect()}
    wanted, allowed = set(), set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[4] != y[4] and x[1] <= y[1]:
                pair = (min(x[3], y[3]), max(x[3], y[3]))
                allowed.add(pair)
                # A link needs 175 * overlap >= 75 * (both sizes), and the overlap is at most what follows the token.
                differ = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(x[5:], y[5:]))
                near = 175 * (x[1] + y[1] - differ) >= 150 * (x[1] + y[1])
                if near and 100 * x[1] >= 75 * y[1] and bool(_may_link(*(np.array(v) for v in (x[1], y[1], x[2], y[2])))):
                    wanted.add(pair)
    assert wanted <= found <= allowed and wanted


@pytest.mark.parametrize("block", [2, 256])
def test_sets_that_share_a_beginning_without_a_link(spark, monkeypatch, block):
    """A long list of one token, a large group of similar sets, and sets close to it."""
    monkeypatch.setattr(jaccard, "BLOCK_ENTRIES", block)
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10**6)}"
    shared, group = [word() for _ in range(9)], [word() for _ in range(60)]
    rows = [(i, " ".join(shared + [word() for _ in range(rnd.choice([6, 7, 20, 21]))])) for i in range(250)]
    for i in range(300, 380):
        w = list(group)
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            w[rnd.randrange(60)] = word()
        rows.append((i, " ".join(w)))
    for i in range(400, 440):  # about as far from the group as links reach
        w = list(group)
        cut = rnd.choice([2, 3, 4, 10, 14, 20])
        w[60 - cut :] = [word() for _ in range(cut)]
        rows.append((i, " ".join(w)))
    found = jaccard_components(documents(spark, rows).repartition(4))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == components_of(rows)


@pytest.mark.parametrize("block", [3, 256])
def test_sets_of_two_pivots_are_not_paired_one_by_one(spark, monkeypatch, block):
    """A large group of similar sets, and sets that are nearly as close as a link: no row for
    each of their pairs."""
    monkeypatch.setattr("millrace.llm.common.SLICE_ROWS", block)
    paired, sketched = [], jaccard.sketched

    def counted(pairs, sets):
        paired.append(pairs.count())
        return sketched(pairs, sets)

    monkeypatch.setattr(jaccard, "sketched", counted)
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(10**6)}"
    group, rows = [word() for _ in range(120)], []
    for i in range(150):
        w = list(group)
        w[rnd.randrange(40)] = word()
        rows.append((i, " ".join(w)))
    for i in range(200, 230):  # a seventh of the group's words is replaced: some link, most just do not
        rows.append((i, " ".join(group[:104] + [word() for _ in range(rnd.choice([13, 14, 15, 16, 17]))])))
    found = jaccard_components(documents(spark, rows).repartition(4))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == components_of(rows)
    assert max(paired) < 1500


def test_very_long_texts(spark):
    rnd = random.Random(9)
    words = [f"word{rnd.randrange(10**5)}" for _ in range(260_000)]  # over 2 MB
    near, far = list(words), list(words)
    near[1000] = "other"
    far[: len(far) // 2] = ["x" + w for w in far[: len(far) // 2]]
    rows = [(3, " ".join(words)), (2, " ".join(near)), (1, " ".join(far)), (4, "short text")]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(documents(spark, rows)).collect()}
    assert found == {3: 2, 2: 2, 1: 1, 4: 4}


def test_postings_take_one_python_worker_a_task(spark, monkeypatch, capsys):
    """Documents that come with their group are left out where postings are made, not by a
    filter in Python before: a task with both would hold two workers."""
    plans, postings = [], jaccard.postings

    def seen(rows, *others):
        rows.explain()
        plans.append(capsys.readouterr().out)
        return postings(rows, *others)

    monkeypatch.setattr(jaccard, "postings", seen)
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(3, text), (2, text), (None, text + " more"), (4, "quite another text of seven words"), (5, None), (6, "")]
    found = jaccard_components(documents(spark, rows))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {2: 2, 3: 2, None: 2, 4: 4, 5: 5, 6: 6}
    assert plans[0].count("ArrowEvalPython") == 1  # the shuffled branch


def test_pairs_meet_sizes_gains_and_sketches_in_one_join_a_side(spark, monkeypatch, capsys):
    """Pairs of pivots are what may be many: they are not joined before their sketches are."""
    asked, sketched = [], jaccard.sketched

    def seen(pairs, sets):
        for df in (pairs, sketched(pairs, sets)):
            df.explain()
            asked.append(capsys.readouterr().out.count("Join "))
        return sketched(pairs, sets)

    monkeypatch.setattr(jaccard, "sketched", seen)
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(3, text), (2, text + " more"), (1, text + " and many other words that make it another text"), (4, None)]
    found = jaccard_components(documents(spark, rows))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == components_of(rows)
    assert asked[2:] == [0, 2]  # of the second call, that on pivots
