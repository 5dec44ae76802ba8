"""Byte-pair encoding with forced boundaries.

A token can only arise from bytes that stand side by side in some token of the
vocabulary. Where two neighbouring bytes of a word never do so, no merge can cross:
the word is cut there, and the fragments are encoded independently and concatenated.
Words are looked up in a bounded cache of each Python worker; the words of a batch that
are new are merged together, one rank of every fragment at a time.

The vocabulary file is read on the driver and shipped to the tasks (a few MB, whatever
the corpus). It has to be of the kind "BPE with word ends": lower case, white space
dropped, ``</w>`` on the last symbol of a word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

# The word pattern and the white space of the tokenizer file.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"
# The same pattern for Latin-1 text, with its letters and numbers spelled out: faster.
LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
LATIN_WORD = rf"[{LETTERS}]+|[{NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0{LETTERS}{NUMBERS}]+"

CACHE_WORDS = 150_000
CHUNK_CHARS = 1_000_000
SLICE_ROWS = 256
NONE = np.iinfo("int32").max


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in the vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = iter(range(256, 512))
    return [chr(b if b in set(shown) else next(hidden)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file's contents."""

    def __init__(self, content: str):
        data = json.loads(content)
        vocab, merges = data["model"]["vocab"], data["model"]["merges"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        n = max([*vocab.values(), *added.values()]) + 1
        self.tokens = [""] * n
        for token, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = token
        shown = byte_characters()
        self.symbol = np.array([vocab[c] for c in shown] + [vocab[c + WORD_END] for c in shown], "int64")
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right = (np.array([vocab[p[k]] for p in pairs], "int64") for k in (0, 1))
        made = np.array([vocab["".join(p)] for p in pairs], "int64")
        keys = left << 20 | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype("int32"), made[order]
        self.joins = self._joins(vocab, shown)
        self.added = {k: int(v).to_bytes(4, "little") for k, v in added.items()}
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.word, self.latin_word = regex.compile(WORD), re.compile(LATIN_WORD)
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _joins(vocab: Iterable[str], shown: list[str]) -> np.ndarray:
        """joins[a, b]: byte a stands before byte b (256 + b: the last of a word) inside
        some token. Elsewhere a cut is certain."""
        number = {c: i for i, c in enumerate(shown)}
        joins = np.zeros((256, 512), bool)
        for token in vocab:
            ends = token.endswith(WORD_END) and token != WORD_END
            symbols = [number[c] for c in (token.removesuffix(WORD_END) if ends else token) if c in number]
            for i, (a, b) in enumerate(zip(symbols, symbols[1:]), 2):
                joins[a, b + 256 * (ends and i == len(symbols))] = True
        return joins

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form
            return self.word.findall(text.lower())
        return self.latin_word.findall(text.lower())  # composed already

    def merge(self, words: list[str]) -> list[bytes]:
        """Token ids of each word, as little-endian 32-bit numbers."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), "int64", len(raw))
        flat = np.frombuffer(b"".join(raw), "uint8").astype("int64")
        ends = np.cumsum(sizes)
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        coded = flat + 256 * last
        ids = self.symbol[coded]
        first = np.concatenate([[True], last[:-1]])
        opens = first.copy()  # of fragments
        opens[1:] |= ~self.joins[flat[:-1], coded[1:]]
        word = np.repeat(np.arange(len(raw)), sizes)
        done_ids, done_at = [], []
        at = np.cumsum(np.ones(len(ids), "int64")) - 1  # place of each symbol, to put fragments together again
        rank = self._rank(ids, opens, np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(opens)
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(ids)))
            active = np.repeat(best < NONE, lengths)
            if not active.all():  # finished fragments leave
                done_ids.append(ids[~active])
                done_at.append(at[~active])
                ids, at, rank, opens = ids[active], at[active], rank[active], opens[active]
                if not len(ids):
                    break
                best, lengths = best[best < NONE], lengths[best < NONE]
            chosen = rank == np.repeat(best, lengths)
            run = np.arange(len(ids)) - np.maximum.accumulate(np.where(chosen, -1, np.arange(len(ids))))
            chosen &= run % 2 == 1  # of overlapping pairs the left one
            here = np.flatnonzero(chosen)
            found = np.searchsorted(self.keys, ids[here] << 20 | ids[here + 1])
            ids[here] = self.made[found]
            stays = np.ones(len(ids), bool)
            stays[here + 1] = False
            touched = chosen.copy()
            touched[here - 1] = True  # the pair before (place -1 is never kept apart: it ends a fragment)
            ids, at, rank, opens, touched = ids[stays], at[stays], rank[stays], opens[stays], touched[stays]
            again = np.flatnonzero(touched | np.append(touched[1:], False))
            rank[again] = self._rank(ids, opens, again)
        out_ids, out_at = np.concatenate([*done_ids, ids]), np.concatenate([*done_at, at])
        order = np.argsort(out_at)
        data = out_ids[order].astype("<u4").tobytes()
        bounds = np.concatenate([[0], np.cumsum(np.bincount(word[out_at], minlength=len(raw)))]) * 4
        bounds = bounds.tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def _rank(self, ids: np.ndarray, opens: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place; NONE where there is none or the
        fragment ends."""
        out = np.full(len(at), NONE, "int32")
        inner = at + 1 < len(ids)
        inner[inner] = ~opens[at[inner] + 1]
        here = at[inner]
        key = ids[here] << 20 | ids[here + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out[inner] = np.where(self.keys[found] == key, self.ranks[found], NONE)
        return out

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text; null is the empty text."""
        chunk, chars = [], 0
        for text in texts:
            chunk.append(text or "")
            chars += len(chunk[-1])
            if chars > CHUNK_CHARS:
                yield from self._encode(chunk)
                chunk, chars = [], 0
        yield from self._encode(chunk)

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [[t] if self.split is None or "<" not in t else self.split.split(t) for t in texts]
        parts = [[self.added.get(p) or self.words(p) for p in text] for text in split]
        new = set()
        for text in parts:
            for p in text:
                if isinstance(p, list):
                    new.update(p)
        if len(self.cache) > CACHE_WORDS:
            self.cache = {w: c for w in new if (c := self.cache.get(w)) is not None}
        new = list(new.difference(self.cache))
        if new:
            self.cache.update(zip(new, self.merge(new)))
        get = self.cache.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in text) for text in parts]

    def decode(self, ids: bytes) -> str:
        """Tokens in order, with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(content: str) -> Codec:
    return Codec(content)


def _content(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _mapped(rows: DataFrame, columns: list[str], of: str, into: str, kind: str, work) -> DataFrame:
    """``rows`` with a column ``into``, made from the column ``of`` a few rows at a time: an
    Arrow batch is never turned into Python objects as a whole."""
    narrow = rows.select(*columns)
    schema = StructType([*narrow.schema.fields, StructField(into, kind)])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                made = pa.array(work(part.column(of).to_pylist()), pa.binary() if into == "ids" else pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, into])

    return narrow.mapInArrow(go, schema)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, ids`` for each row: ``ids`` are the tokens of the whole text as packed
    little-endian unsigned 32-bit numbers (binary, four bytes a token). Null and the empty
    text give no tokens. Rows without an id and repeated rows are encoded like all others;
    other columns are not read. ``vocabulary`` is the path of the file on the driver."""
    content = _content(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    work = lambda texts: list(_codec(content).encode(texts))
    return _mapped(rows, ["doc_id", "text"], "text", "ids", BinaryType(), work)


def decode(coded: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, decoded`` for each row of packed ids, special tokens included; null ids
    give null."""
    content = _content(vocabulary)
    work = lambda ids: [None if p is None else _codec(content).decode(p) for p in ids]
    return _mapped(coded, ["doc_id", "ids"], "ids", "decoded", StringType(), work)
