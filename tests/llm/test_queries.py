"""Registered queries against their SQL, and against what the contracts state."""

import hashlib

import pytest
from check import TESTDATA, connect

from millrace.llm.catalog import ORACLES, QUERIES, rank_vocabulary, word_vocabulary

SF_DIR = f"{TESTDATA}/sf0.001"


def cells(rows, order):
    return sorted((tuple(r[c] for c in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    cursor = connect(SF_DIR).execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    theirs = cells((dict(zip(names, r)) for r in cursor.fetchall()), names)
    found = QUERIES[key](spark, SF_DIR)
    assert sorted(found.columns) == sorted(names)
    assert cells((r.asDict() for r in found.collect()), names) == theirs


def test_all_operators_have_a_query():
    import __spark_entry__ as entry

    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


def test_shards(spark):
    rows = QUERIES["op5_sharding"](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    assert sorted(rows["doc_id"]) == sorted(docs["doc_id"])
    assert set(rows["law"]) == {"bytes"} and rows["grown_shard"].isna().all()
    sums = rows.groupby("shard")["size"].sum()
    assert len(sums) == 40 and sums.max() - sums.min() <= rows["size"].max()
    for _, slots in rows.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_codes_equal_those_of_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_vocabulary())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in QUERIES["op7_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op10_quality"](spark, f"{TESTDATA}/sf0.01")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    met = rows.join(labels, "doc_id").where("held_out").toPandas()
    assert len(met) > 50 and (met["predicted"] == met["quality"]).mean() > 0.95


def test_languages(spark):
    rows = QUERIES["op9_language_id"](spark, SF_DIR).toPandas()
    assert (rows["lang"] == rows["declared"]).mean() > 0.98
    assert rows["accepted"].all() and rows["confidence"].between(0, 1).all()


def test_byte_codes_equal_those_of_the_library(spark):
    import base64

    import tiktoken

    path, pattern = rank_vocabulary()
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in QUERIES["op13_byte_bpe"](spark, SF_DIR).collect():
        ids = library.encode_ordinary(texts[row["doc_id"]] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode_bytes(ids)).hexdigest()
