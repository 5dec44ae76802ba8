"""The pipeline on given tables with planted rows, and on odd ones."""

import pytest
from check import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline as C


@pytest.fixture
def planted(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id < 40 AND length(text) > 1500").collect()}
    (a, one), (b, two) = list(texts.items())[:2]
    passage = one[200:700]
    rows = [
        (90_000, one, "en"), (90_001, one.replace(" ", "  "), "en"), (90_002, "extra word " + one, "en"),
        (90_003, two + passage, "en"), (90_004, None, "en"), (90_005, "", "en"), (90_006, "12 34", "en"),
        (None, "der hund und die katze waren nicht mit ihm im haus", "de"),
        (None, "der hund und die katze waren nicht mit ihm im haus", "de"),
    ]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = more.withColumn("source", F.lit("src0")).withColumn("n_chars", F.length("text").cast("long"))
    both = docs.unionByName(more.select(docs.columns)).withColumn("t", F.lit("clash"))
    both.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), a, b, passage


def test_stages(spark, planted, tmp_path):
    folder, a, b, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append({r["doc_id"]: r for r in docs.collect()} if i < 4 else docs.toPandas())
    language, exact, near, suffix, packed = kept
    assert not {90_004, 90_005, 90_006} & set(language) and {a, b, 90_003, None} <= set(language)
    assert not {90_000, 90_001} & set(exact) and {a, 90_002} <= set(exact)
    assert 90_002 not in near and {a, b} <= set(near)
    assert set(suffix) == set(near)
    assert passage in suffix[a]["text"]
    assert all(passage not in r["text"] for d, r in suffix.items() if d != a)
    assert all(r["n_chars"] == len(r["text"]) for r in suffix.values())
    assert set(packed["doc_id"].dropna()) == {d for d in suffix if d is not None}


def test_passages_of_short_words(spark):
    """51 words in under 256 bytes go, 50 stay; of a long text in parts as well."""
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{i % 7}" for i in range(51)]
    passage, less = " ".join(words), " ".join(reversed(words[1:]))
    assert len(passage) < C.PASSAGE_BYTES
    filler = " ".join(f"filler{i:07d}" for i in range(150_000))[: (1 << 21) - 100]
    rows = [
        (1, "Er sagt: " + passage + ". Und geht"), (2, "Da steht (" + passage + ")\nund mehr"), (3, filler + " " + passage + " ende"),
        (4, "eins " + less + " zwei"), (5, "drei " + less + " vier"), (6, passage), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in C.suffix_dedup(spark, docs, "").collect()}
    assert out == dict(rows) | {2: "Da steht ()\nund mehr", 3: filler + "  ende", 6: ""}


def test_run(spark):
    out = C.run(spark, f"{TESTDATA}/sf0.001")
    assert out.count() > 0 and out.columns[0] == "doc_id"


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
