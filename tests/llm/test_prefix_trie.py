"""Prefix tree against a plain one of tuples."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import prefix_trie
from millrace.llm.prefix_trie import conversation_trie, ordered_digests
from millrace.plans.ordered import HOT_ROWS_CONF

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, every=100, most=5):
    own = {}
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()
    for c, n, r, t in rows:
        if c is not None:
            own.setdefault(c, []).append((n is not None, n or 0, digest(r or "", t or ""), (r or "", t or "")))
    own = {c: [x[-1] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        built[c] = tuple(own.get(c - c % every, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        own_saving = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saving + sum(saved[b] for b in below)
        leaves[node] = sum(leaves[b] for b in below) if below else 1
    out = []
    for node, met in members.items():
        ends = ",".join(str(c) for c in sorted(met) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(met), len(node), parent, len(met), len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("pos", "node", "block", "digest", "chars", "base", "h"):
        df = df.withColumn(clash, F.lit("x"))
    return sorted((tuple(r) for r in conversation_trie(df).select(*COLUMNS).collect()), key=repr)


def conversations(seed, n=160):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        turns = draw.choice([0, 1, 2, 3, 5, 8, 13])
        if c % 100 == 0:
            turns = draw.choice([0, 3, 9])
        for i in range(turns):
            rows.append((c, draw.choice([i, i, i, None]), draw.choice(["user", "a", None]), draw.choice(["x", "yy", "é🤦", None])))
    rows += [(c, i, "user", "hot") for c in range(300, 340) for i in range(6)]  # one conversation many times
    rows += [(777, i, "user", f"{i % 3}") for i in range(60)]  # a long one
    rows += [(778, i, "user", f"{i % 3}") for i in range(60)]
    rows += [(5, 0, "user", "again"), (5, 0, "user", "again"), (None, 0, "user", "nobody"), (801, 0, "user", "z" * 100_000)]
    draw.shuffle(rows)
    return rows


def test_equals_a_plain_tree(spark):
    rows = conversations(1)
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("block", [1, 3])
def test_block_length_does_not_matter(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    rows = conversations(2, 60)
    assert found(spark, rows) == plain(rows)


def test_hot_conversations_are_sliced(spark):
    spark.conf.set(HOT_ROWS_CONF, "20")
    try:
        rows = conversations(3, 40)
        assert found(spark, rows) == plain(rows)
    finally:
        spark.conf.unset(HOT_ROWS_CONF)


def test_nothing_and_turnless(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "a", "b")]) == []
    c = next(c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "gone")]  # its opening would come from a conversation that is absent
    assert found(spark, rows) == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


@pytest.mark.parametrize("piece", [1, 7, 1_000])
def test_lists_are_hashed_in_pieces(spark, piece):
    rows = [(b"a", i * 3 % 1009 - 500) for i in range(1009)] + [(b"b", 5)]
    members = spark.createDataFrame(rows, "node binary, conv_id long").repartition(5)
    wanted = {n: hashlib.sha256(",".join(str(c) for m, c in sorted(rows) if m == n).encode()).hexdigest() for n in (b"a", b"b")}
    assert {bytes(r["node"]): r["ends_sha256"] for r in ordered_digests(members, piece).collect()} == wanted
