"""Byte-level BPE against the tiktoken library."""

import base64
import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import byte_bpe
from millrace.llm.byte_bpe import ByteCodec, decode_bytes, encode_bytes
from millrace.llm.catalog import rank_vocabulary

PATH, PATTERN = rank_vocabulary()


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return ByteCodec(file.read(), PATTERN)


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def compare(codec, library, texts):
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        wanted = library.encode_ordinary(text)
        assert ids == packed(wanted), repr(text[:80])
        assert codec.decode(ids) == text.encode()


TEXTS = [
    "", " ", "a", "don't we'll I'M", "  two  blanks\n\n\ttab \r\n", "x" * 700, "ab" * 5_000, " " * 3_000 + "end",
    "naïve café Ünïcödé ÀÖØ×÷", "日本語のテキスト、漢字", "🤦🏼‍♂️ emoji 👍", "١٢٣ ½ ² 12345", "<|endoftext|> is text",
    "a\x1cb\x1d c\x85d\xa0e f　g​h", "\x00\x01\x7f", "word " * 2_000, "é" * 600, "ſ'ſ 'S", "áé",
]


def test_texts_of_many_kinds(codec, library):
    compare(codec, library, TEXTS)


def test_every_code_point(codec, library):
    """Code points that one of the two matchers does not know yet are classed differently."""
    import unicodedata

    known = [chr(c) for c in range(0x30000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    texts = ["".join(f"{c}a {c}{c}1 " for c in known[i : i + 500]) for i in range(0, len(known), 500)]
    compare(codec, library, texts)


def test_latin_classes_are_those_of_unicode(codec):
    text = "".join(f"{chr(c)}a {chr(c)}{chr(c)}1 {chr(c)}" for c in range(256))
    assert codec.latin.findall(text) == codec.pattern.findall(text)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(codec, library, seed):
    draw = random.Random(seed)
    signs = ["abcdefgh", "aeiou nrst", "aA1 .\n'", "äöüßéèê nrt", "абвгде ", "漢字仮名"][seed % 6 :] + [" \t\n"]
    compare(codec, library, ["".join(draw.choices(draw.choice(signs), k=draw.randint(1, 400))) for _ in range(300)])


@pytest.mark.parametrize("longest", [4, 8, 512])
def test_both_ways_of_merging_agree(codec, library, monkeypatch, longest):
    """Rows of a matrix and the heap for long pieces give the same ids."""
    monkeypatch.setattr(byte_bpe, "LONG_BYTES", longest)
    draw = random.Random(5)
    pieces = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 200))).encode() for _ in range(300)]
    wanted = [packed(library.encode_ordinary(p.decode())) for p in pieces]
    assert codec.merge(pieces) == wanted


def test_very_long_texts_and_small_caches(library, monkeypatch):
    for name, value in {"CHUNK_CHARS": 1_000, "STRETCH_PIECES": 37, "CACHE_PIECES": 5, "CELLS": 600}.items():
        monkeypatch.setattr(byte_bpe, name, value)
    with open(PATH, "rb") as file:
        codec = ByteCodec(file.read(), PATTERN)
    compare(codec, library, ["short", "The quick brown fox jumps. " * 300, "", "añadir más y más\n" * 200, "z"])
    assert len(codec.cache) < 600


def test_table(spark, library):
    rows = [(1, "a b"), (2, None), (2, ""), (None, "a b"), (3, "Zwei  Wörter " * 3), (3, "Zwei  Wörter " * 3), (4, "x" * 1_200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for clash in ("ids", "decoded", "part"):
        docs = docs.withColumn(clash, F.lit("x"))
    found = decode_bytes(encode_bytes(docs, PATH, PATTERN), PATH, PATTERN).collect()
    wanted = [(d, packed(library.encode_ordinary(t or "")), (t or "").encode()) for d, t in rows]
    assert sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in found), key=repr) == sorted(wanted, key=repr)
    assert encode_bytes(docs.where("false"), PATH, PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert decode_bytes(nothing, PATH, PATTERN).first()["decoded"] is None
