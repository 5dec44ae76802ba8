"""Operators on small inputs, against plain Python: nulls, empty texts and tables, ties,
repeated rows, clashing columns, hot groups."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import sharding, suffix_dedup
from millrace.llm.bpe import Codec, decode, encode
from millrace.llm.catalog import word_vocabulary
from millrace.llm.common import BATCH_BYTES, BATCH_CONF
from millrace.llm.exact_dedup import Directory, exact_duplicates, grow_directory
from millrace.llm.jaccard import jaccard_components
from millrace.llm.langid import identify
from millrace.llm.packing import SIZES, best_plan, pack, pack_histogram, sequence_cost
from millrace.llm.quality import quality_scores
from millrace.llm.sharding import shard_by_bytes, write_shards
from millrace.llm.topk import top_k
from millrace.llm.url_filter import build_cascade, in_cascade, judge_urls

DOC = "doc_id long, text string"


def documents(spark, rows, extra=True):
    """With columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, DOC)
    for name in ("key", "t", "n", "unit", "hash", "norm", "slice", "size", "bucket", "begin", "none") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# exact dedup
TEXTS = [
    (5, "a  b"), (3, "a b"), (9, "a\t\nb"), (4, "a b "), (7, None), (8, ""), (8, ""), (2, "x"), (None, "x"),
    (None, "alone"), (11, "é"), (12, "e\u0301"), (13, "b" * 50_000), (14, "b" * 50_000),
]


@pytest.mark.parametrize("hash_bits", [64, 2])
def test_exact_duplicates(spark, hash_bits):
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in TEXTS]
    least, sizes = {}, Counter(t for _, t in norm)
    for d, t in norm:
        least[t] = min([x for x in (least.get(t), d) if x is not None], default=None)
    wanted = sorted(((d, least[t], sizes[t], d is not None and d == least[t]) for d, t in norm), key=repr)
    found = exact_duplicates(documents(spark, TEXTS), capacity=2, hash_bits=hash_bits)
    assert tuples(found, "doc_id", "keep_id", "group_size", "kept") == wanted
    chains = {r["chain"] for r in found.collect()}
    assert (max(chains) > 1) == (hash_bits == 2)


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(documents(spark, [])).count() == 0


def test_groups_are_found_through_the_directory(spark, monkeypatch):
    """A directory that files everything under another bucket than the rows' own finds none."""
    texts = [(i, f"text {i % 40}") for i in range(200)]
    found = exact_duplicates(documents(spark, texts), capacity=4)
    assert found.count() == 200 and found.select("bucket").distinct().count() > 4
    assert {tuple(r) for r in found.select("doc_id", "keep_id", "group_size").collect()} == {(i, i % 40, 5) for i in range(200)}
    file = Directory.file
    moved = lambda self, rows: file(self, rows).withColumn("bucket", F.col("bucket") + int("sha" in rows.columns))
    monkeypatch.setattr(Directory, "file", moved)
    assert exact_duplicates(documents(spark, texts), capacity=4).count() == 0


def test_directory_covers_every_hash_once():
    rnd = random.Random(3)
    counts = {rnd.randrange(256): rnd.randrange(1, 9) for _ in range(60)}
    depth, buckets = grow_directory(counts, 12, max_depth=8)
    covered = [c for p, local in buckets for c in range(p << (8 - local), (p + 1) << (8 - local))]
    assert covered == list(range(256)) and depth == max(local for _, local in buckets)
    for p, local in buckets:
        held = sum(counts.get(c, 0) for c in range(p << (8 - local), (p + 1) << (8 - local)))
        assert held <= 12 or local == 8


# url filter
URLS = [
    "http://a.net/x", "https://EXAMPLE.net/en/1?q=/de/", "x://www.example.com/de/", "http://example.com/De/",
    "http://sub.org/fr/#a", "org/fr/", "http://org/fr/", "http://net", "http://net?x", "http://xnet/", None, "", "://",
    "http://a://net/", "http://b.net:80/", "http://..net/", "http://example.net/e", "a\nb://q.net/\n",
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("max_listed", [100, 0])
def test_urls(spark, max_listed):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("keys", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = judge_urls(pages, rules, max_listed=max_listed)
    assert tuples(found, "page_id", "host", "path", "rule", "verdict") == sorted(
        ((i, *judged(u)) for i, u in enumerate(URLS)), key=repr
    )


def test_urls_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert tuples(judge_urls(pages, none), "rule", "verdict") == [(None, "allow")]
    assert judge_urls(pages.limit(0), none).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.where(F.substring("key", 2, 9).cast("int") % 17 == 0)
    levels = build_cascade(listed, keys, 4000)
    assert len(levels) > 1
    passed = {r["key"] for r in keys.where(in_cascade(levels, F.col("key"))).collect()}
    assert passed == {r["key"] for r in listed.collect()}


# sharding
def test_hot_text_is_spread_and_others_stay_together(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, "hot" * 30) for i in range(400)] + [(1000 + i, "w" * rnd.randrange(300)) for i in range(800)] + [(None, None), (7, "hot" * 30)]
    found = shard_by_bytes(documents(spark, rows), 8).toPandas()
    sums = found.groupby("shard")["size"].sum()
    assert len(found) == len(rows) and sums.max() - sums.min() <= 400
    split = found.groupby("text_crc32")["shard"].nunique()
    assert (split > 1).sum() == 1
    write_shards(documents(spark, rows), 8, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(rows) and back.select("shard").distinct().count() == 8
    assert shard_by_bytes(documents(spark, []), 8).count() == 0


def test_many_rows_of_few_bytes(spark, monkeypatch, tmp_path):
    """A text of very many rows is numbered in pieces, and still shares one shard."""
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 50)
    rows = [(i, None if i % 2 else "") for i in range(600)] + [(i, f"{i} " * 200) for i in range(600, 900)]
    found = shard_by_bytes(documents(spark, rows), 4).toPandas()
    empty = found[found["size"] == sharding.RECORD_BYTES]
    assert len(found) == len(rows) and len(empty) == 600
    assert empty["shard"].nunique() == 1 and empty.groupby("unit").size().max() < 120
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in found.groupby("shard"))
    write_shards(documents(spark, rows), 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r["doc_id"] for r in back.select("doc_id").collect()) == list(range(900))
    assert back.where("coalesce(text, '') = ''").select("shard").distinct().count() == 1


# packing
def test_pack_holds_every_token_once(spark):
    rows = [(i, "w " * (i * 37 % 700)) for i in range(300)] + [(None, None), (1, ""), (2, "x " * 5000), (2, "x " * 5000)]
    found = pack(documents(spark, rows), sizes=(64, 256, 1024)).toPandas()
    assert found["n_tokens"].sum() == sum(len((t or "").split()) + 1 for _, t in rows)
    for _, b in found.sort_values("bin_offset").groupby("bin_id"):
        assert list(b["bin_offset"]) == [0, *b["n_tokens"].cumsum()[:-1]]
        size = b["bin_size"].iloc[0]
        assert b["n_tokens"].sum() <= size and (size == 64 or b["n_tokens"].sum() > {256: 64, 1024: 256}[size])
    assert pack(documents(spark, [])).count() == 0


def test_histogram_packs_like_items_one_by_one():
    rnd = random.Random(2)
    counts = Counter(rnd.choice([3, 50, 100, 333, 500, 511, 512]) for _ in range(200))
    plan = pack_histogram(counts, (512,), sequence_cost, 512)
    room = []
    for length in sorted(counts.elements(), reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(512 - length)
    assert sorted(h for _, k, h in plan.bins for _ in range(k)) == sorted(512 - r for r in room)
    best = best_plan(counts, SIZES)
    assert best.cost <= min(pack_histogram(counts, SIZES, opening=s).cost for s in SIZES)


# byte pairs
def test_codes_of_odd_texts(spark):
    from tokenizers import Tokenizer

    library, path = Tokenizer.from_file(word_vocabulary()), word_vocabulary()
    rnd = random.Random(5)
    texts = ["", " \n", "aaaa" * 500, "it's <|endoftext|>x<|startoftext|>", "ΑΣ ΣΑΣ İ", "e\u0301 ½x²", "\x1c\x85\u2028a"]
    texts += ["".join(rnd.choice("abeinrth'.,! éÉßſ́漢<|") for _ in range(rnd.randrange(60))) for _ in range(2000)]
    rows = list(enumerate(texts)) + [(None, None)]
    coded = encode(documents(spark, rows), path)
    found = {r["doc_id"]: r for r in decode(coded, path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(found[i]["ids"]) == b"".join(x.to_bytes(4, "little") for x in ids), text
        assert found[i]["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bytes(found[None]["ids"]) == b"" and found[None]["decoded"] == ""
    assert encode(documents(spark, []), path).count() == 0


def test_boundaries_are_forced():
    with open(word_vocabulary(), encoding="utf-8") as file:
        codec = Codec(file.read())
    assert 0 < codec.joins.mean() < 0.5  # most pairs of bytes are certain cuts


# suffix dedup
def removed(rows, m, first):
    raws = [(d, (t or "").encode()) for d, t in rows]
    counts, seen, out = Counter(r[i : i + m] for _, r in raws for i in range(len(r) - m + 1)), set(), []
    for d, r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - m + 1):
            if (r[i : i + m] in seen) if first else counts[r[i : i + m]] > 1:
                gone[i : i + m] = b"\1" * m
            seen.add(r[i : i + m])
        out.append((d, bytes(b for b, g in zip(r, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("first, hot", [(False, 1024), (True, 1024), (False, 2), (True, 2)])
def test_repeats(spark, monkeypatch, first, hot):
    monkeypatch.setattr(suffix_dedup, "OPEN_SEGMENTS", hot)
    rnd = random.Random(7)
    words = lambda n: " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 6))) for _ in range(n))
    passages, rows = [words(60) for _ in range(4)], [(-1, None), (0, "")]
    for i in range(1, 60):
        text = words(rnd.randrange(60))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            text += p[a : a + rnd.randrange(300)] + words(rnd.randrange(10))
        rows.append((i, text))
    rows += [(100, rows[5][1]), (101, "a" * 500), (102, "ab" * 130)]
    if not first:
        rows += [(None, rows[7][1]), (101, "a" * 500)]
    found = suffix_dedup.remove_repeats(documents(spark, rows), 100, keep_first=first)
    assert [(d, bytes(k)) for d, k in tuples(found, "doc_id", "_kept")] == removed(rows, 100, first)


def test_repeats_across_stretches(spark):
    rnd, n = random.Random(8), suffix_dedup.CHUNK_BYTES
    text = lambda size: "".join(rnd.choices("abcdefghijklmnop", k=size))
    passage, edge = text(900), text(150)
    long = text(n - 450) + "<" + passage + ">" + text(n) + edge + text(77)
    rows = [(1, long), (2, text(50) + "[" + passage + "]" + text(30)), (3, edge), (4, text(2 * n + 5))]
    found = suffix_dedup.remove_repeats(documents(spark, rows), 100, keep_first=False)
    assert [(d, bytes(k)) for d, k in tuples(found, "doc_id", "_kept")] == [
        (d, t.replace(passage, "").replace(edge, "").encode()) for d, t in rows
    ]


def test_segments_hold_little_memory():
    n = suffix_dedup.CHUNK_BYTES
    data = np.random.default_rng(3).integers(97, 123, n, "uint8")
    suffix_dedup.Rolling(data)  # the tables that all texts share
    tracemalloc.start()
    suffix_dedup.segments(data, np.array([0, n // 2, n]), 256, 48)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48e6


def test_texts_are_sent_in_small_batches(spark, monkeypatch):
    sizes, store = {}, suffix_dedup.materialise

    def stored(df, name):
        sizes[name] = spark.conf.get(BATCH_CONF)
        return store(df, name)

    monkeypatch.setattr(suffix_dedup, "materialise", stored)
    before = spark.conf.get(BATCH_CONF)
    suffix_dedup.remove_repeats(documents(spark, [(1, "a b " * 60), (2, "b c " * 60)]), 100, words=5)
    assert {sizes[k] for k in ("segments", "repeated-windows", "word-windows")} == {str(BATCH_BYTES)}
    assert spark.conf.get(BATCH_CONF) == before


def test_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


# near duplicates
def components_of(rows):
    up, sets = {i: i + 32 for i in range(65, 91)}, []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(up))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_near_duplicates(spark):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ab", "é", "A"]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 6, 20, 60, 120]))] for _ in range(30)]
    common, rows = [rnd.choice(vocabulary) for _ in range(40)], []
    for i in range(300):
        w = list(bases[0] if i % 3 == 0 else rnd.choice(bases))  # one base has a third of the rows
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((i, rnd.choice(["  ", " ", "\n"]).join(w + common * (rnd.random() < 0.3))))
    rows += [(900, None), (901, ""), (902, " \t"), (903, "one two"), (904, "ONE two"), (905, rows[7][1]), (905, rows[7][1])]
    rows += [(None, rows[9][1]), (None, "lonely words of a row without id"), (None, None)]
    found = jaccard_components(documents(spark, rows).repartition(3))
    assert tuples(found, "doc_id", "n_shingles", "component_id") == components_of(rows)


def test_near_duplicates_of_nothing(spark):
    assert jaccard_components(documents(spark, [])).count() == 0


# top k
def test_top_k(spark):
    rnd = random.Random(6)
    vectors = [(i, [float(rnd.randrange(-3, 4)) for _ in range(4)]) for i in range(300)]
    vectors += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(300, 420)]  # one vector of many rows
    odd = [(500, None), (501, [1.0, None, 0.0, 0.0]), (502, [float("nan")] * 4), (503, [float("inf")] * 4), (None, [9.0] * 4)]
    odd += [(550, [2.0, 2.0]), (551, [1.0, 1.0]), (552, []), (0, vectors[0][1])]
    table = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    found = top_k(table, F.col("vec_id") % 50 == 0, 5, scale=1, pivots=4, first_rings=(1,))
    usable = {**dict(vectors), 550: [2.0, 2.0], 551: [1.0, 1.0], 552: []}
    wanted = []
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(int(a * b) for a, b in zip(v, w)), c) for c, w in usable.items() if c != q and len(w) == len(v))
            wanted += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:5], 1)]
    assert tuples(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)
    assert top_k(table.limit(0), F.lit(True), 5).count() == 0


def test_top_k_of_repeated_ids(spark):
    """Every vector of an id asks and is found, as in the SQL of the query."""
    rnd = random.Random(7)
    rows = [(i % 60, [float(rnd.randrange(-9, 10)) for _ in range(4)]) for i in range(200)]
    assert len({(i, tuple(v)) for i, v in rows}) == len(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(table, F.col("vec_id") % 20 == 0, 5, scale=1, pivots=4, first_rings=(1,))
    wanted = []
    for q in (0, 20, 40):
        scores = sorted((-sum(int(a * b) for a, b in zip(v, w)), c) for i, v in rows if i == q for c, w in rows if c != q)
        wanted += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:5], 1)]
    assert tuples(found, "query_id", "rank", "vec_id", "score") == sorted(wanted, key=repr)


# language and quality
def test_language_of_odd_records(spark):
    en, de = "the cat and the dog were in the house with them", "der hund und die katze waren nicht mit ihm im haus"
    rows = [(i, en, "en-US", "a.example.com") for i in range(30)] + [(i, de, "DE", "b.example.de") for i in range(30, 60)]
    rows += [(60, None, "en", "x"), (61, "", None, None), (62, "12 34 !!", "de", ""), (None, en, None, None), (63, en, "de", "b.example.de"), (63, en, "xx", "..")]
    table = spark.createDataFrame(rows, "id long, text string, declared string, host string").withColumn("own", F.lit(1))
    found = {(r["id"], r["declared"]): (r["lang"], r["accepted"]) for r in identify(table, ("en", "de")).collect()}
    assert found[0, "en"] == ("en", True) and found[30, "de"] == ("de", True)
    assert found[60, "en"] == found[61, None] == found[62, "de"] == ("und", False)
    assert found[None, None] == ("en", True) == found[63, None]
    assert identify(table.limit(0)).count() == 0


def test_quality_without_labels_and_of_odd_texts(spark):
    docs = documents(spark, [(1, "fine words here."), (2, None), (3, ""), (None, "x | y | z"), (3, "")])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_scores(docs, labels).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, 7), (3, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality_scores(docs, some).collect()} == {0.5}
    assert quality_scores(documents(spark, []), labels).count() == 0
