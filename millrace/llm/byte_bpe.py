"""Byte-level BPE by ranks, over padded matrices.

A text is split by the pattern that belongs to the ranks; each match is a piece and is
encoded alone. A piece that is a token itself is that token. The others are sorted into
buckets by length and become rows of a matrix of token ids, padded to the longest of
their bucket. In each round every row merges its leftmost pair of the smallest rank; all
rows of a bucket have then lost one symbol, so the matrix is compacted by a column, and
rows without a pair in the vocabulary leave. Ranks of pairs come from an open-addressing
hash table, which is asked for a whole column of pairs at once and only for the two pairs
beside each merge.

A round costs the width of the matrix, and a row needs as many rounds as it has merges.
Pieces of more than ``LONG_BYTES`` bytes (one word or one run of blanks of that length)
take the same merges in the same order from a heap of pairs instead.

Encoded pieces are kept in a bounded cache of each Python worker. The ranks are read on
the driver and shipped to the tasks (under a megabyte, whatever the corpus).
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices

NONE = np.iinfo("int32").max
#: Rows of a matrix are padded to one of these widths.
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512)
LONG_BYTES = WIDTHS[-1]
#: Cells of one matrix.
CELLS = 1 << 20
#: Pieces in the cache of a worker, and their characters.
CACHE_PIECES = 150_000
CACHE_CHARS = 8_000_000
#: Pieces of one text that are Python objects at one time; characters of texts split together.
STRETCH_PIECES = 250_000
CHUNK_CHARS = 1_000_000

# Latin-1 characters by class, for texts that have no others: the standard library's
# matcher is faster than one that knows all of Unicode.
LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"\p{N}": "0-9²³¹¼½¾", r"\s": r"\t-\r \x85\xa0"}


def latin_pattern(pattern: str) -> str:
    """``pattern`` with its classes spelled out for Latin-1 text."""
    inside = re.sub(r"\[[^\]]*\]", lambda m: _spelled(m.group(), LATIN), pattern)
    outside = {name: f"[{signs}]" for name, signs in LATIN.items()} | {r"\S": f"[^{LATIN[chr(92) + 's']}]"}
    return "".join(p if p.startswith("[") else _spelled(p, outside) for p in re.split(r"(\[[^\]]*\])", inside))


def _spelled(part: str, names: dict[str, str]) -> str:
    for name, signs in names.items():
        part = part.replace(name, signs)
    return part


def unicode_pattern(pattern: str) -> str:
    """``pattern`` with white space as Unicode defines it: the matcher's own class also
    holds the separators U+001C to U+001F."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class PairTable:
    """Ranks of pairs of token ids: open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.mask = size - 1
        self.keys = np.full(size, -1, "int64")
        self.ranks = np.full(size, NONE, "int32")
        slot, todo = self._home(keys), np.arange(len(keys))
        self.probes = 1
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]  # of those that want one slot the last gets it
            held = self.keys[slot] == keys[todo]
            self.ranks[slot[held]] = ranks[todo[held]]
            slot, todo = (slot[~held] + 1) & self.mask, todo[~held]
            self.probes += bool(len(todo))

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype("int64") & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where the pair is no token or one side is padding (-1)."""
        keys = left.astype("int64") << 32 | right.astype("int64")
        out = np.full(len(keys), NONE, "int32")
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._home(keys[todo])
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            on = ~hit & (there != -1)
            if not on.any():
                break
            slot, todo = (slot[on] + 1) & self.mask, todo[on]
        return out


class ByteCodec:
    """Encoder and decoder of one list of ranks, given as the contents of a rank file."""

    def __init__(self, content: bytes, pattern: str):
        lines = (line.split() for line in content.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], "int32")
        get = self.ranks.get
        pairs = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (left := get(token[:i])) is not None and (right := get(token[i:])) is not None
        ]
        left, right, rank = np.array(pairs, "int64").reshape(-1, 3).T
        self.pairs = PairTable(left << 32 | right, rank.astype("int32"))
        self.pattern = regex.compile(unicode_pattern(pattern))
        self.latin = re.compile(latin_pattern(pattern))
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def _matcher(self, text: str):
        if text.isascii():
            return self.latin
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern
        return self.latin

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each non-empty piece, packed as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(pieces)
        waiting: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG_BYTES:
                out[i] = self._merge_long(piece)
            else:
                waiting.setdefault(next(w for w in WIDTHS if w >= len(piece)), []).append(i)
        for width, rows in waiting.items():
            for a in range(0, len(rows), CELLS // width):
                part = rows[a : a + CELLS // width]
                for i, ids in zip(part, self._merge_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), "uint8").reshape(-1, width)
        length = np.fromiter(map(len, pieces), "int64", len(pieces))
        ids = np.where(np.arange(width) < length[:, None], self.byte[raw], -1).astype("int32")
        rank = np.full(ids.shape, NONE, "int32")
        rank[:, :-1] = self.pairs.get(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        row = np.arange(len(ids))
        out: list[bytes] = [b""] * len(ids)
        while len(row):
            at = rank.argmin(1)  # the leftmost of equals
            best = rank[np.arange(len(row)), at]
            done = best == NONE
            if done.any():
                left = ids[done]
                for i, codes, n in zip(row[done].tolist(), left.astype("<u4"), (left >= 0).sum(1).tolist()):
                    out[i] = codes[:n].tobytes()
                ids, rank, row, at, best = ids[~done], rank[~done], row[~done], at[~done], best[~done]
                if not len(row):
                    break
            every = np.arange(len(row))
            ids[every, at] = best
            # The right half of each pair goes, and with it a column of the matrix.
            stays = np.ones(ids.shape, bool)
            stays[every, at + 1] = False
            width = ids.shape[1] - 1
            ids, rank = ids[stays].reshape(-1, width), rank[stays].reshape(-1, width)
            padded = np.full((len(row), width + 2), -1, "int32")
            padded[:, 1:-1] = ids
            rank[every, at] = self.pairs.get(best, padded[every, at + 2])
            inner = at > 0
            rank[every[inner], at[inner] - 1] = self.pairs.get(padded[every, at][inner], best[inner])
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges, smallest rank first and leftmost among equals, from a heap."""
        tokens, ranks = self.tokens, self.ranks
        part = [bytes([b]) for b in piece]
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        get = ranks.get
        heap = [(r, i) for i in range(len(part) - 1) if (r := get(part[i] + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= len(part) or part[i] + part[j] != tokens[rank]:
                continue  # one side has changed since
            part[i], part[j] = tokens[rank], None
            after[i] = k = after[j]
            if k < len(part):
                before[k] = i
                if (r := get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([ranks[p] for p in part if p is not None], "<u4").tobytes()

    def _codes(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The cache, which then holds all of ``pieces``."""
        if len(self.cache) > CACHE_PIECES or self.cached > CACHE_CHARS:
            self.cache, self.cached = {}, 0
        new = list(set(pieces).difference(self.cache))
        if new:
            self.cache.update(zip(new, self.merge([p.encode() for p in new])))
            self.cached += sum(map(len, new))
        return self.cache

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Packed ids of each text; null is the empty text."""
        chunk, chars = [], 0
        for text in texts:
            text = text or ""
            if len(text) > CHUNK_CHARS:
                yield from self._encode(chunk)
                yield self._encode_long(text)
                chunk, chars = [], 0
                continue
            chunk.append(text)
            chars += len(text)
            if chars > CHUNK_CHARS:
                yield from self._encode(chunk)
                chunk, chars = [], 0
        yield from self._encode(chunk)

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [self._matcher(t).findall(t) for t in texts]
        get = self._codes(p for pieces in split for p in pieces).__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]

    def _encode_long(self, text: str) -> bytes:
        """A stretch of pieces at a time; stretches end where a piece ends."""
        found = (m.group() for m in self._matcher(text).finditer(text))
        out = bytearray()
        while pieces := list(islice(found, STRETCH_PIECES)):
            out += b"".join(map(self._codes(pieces).__getitem__, pieces))
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _codec(content: bytes, pattern: str) -> ByteCodec:
    return ByteCodec(content, pattern)


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_bytes(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids`` for each row: ``ids`` are the tokens of the whole text as packed
    little-endian unsigned 32-bit numbers (binary, four bytes a token).

    Null and the empty text give no tokens. Rows without an id and repeated rows are
    encoded like all others; texts over ``CHUNK_CHARS`` characters are encoded in
    stretches of whole pieces; an empty table gives no rows; other columns are not read.
    Strings of special tokens are ordinary text. ``vocabulary`` is the path of a rank file
    on the driver, ``pattern`` the pattern that splits text for it; it may use ``\\p{L}``,
    ``\\p{N}``, ``\\s`` and ``\\S``.
    """
    content = _content(vocabulary)

    def work(parts: Iterator[dict]) -> Iterator[dict]:
        codec = _codec(content, pattern)
        for part in parts:
            yield {"doc_id": part["doc_id"], "ids": list(codec.encode(part["text"]))}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(rows, "doc_id long, ids binary", work)


def decode_bytes(coded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded`` for each row of packed ids; ``decoded`` are the bytes of the
    tokens one after the other. Null ids give null; an id that is not in the vocabulary
    stops the job."""
    content = _content(vocabulary)

    def work(parts: Iterator[dict]) -> Iterator[dict]:
        codec = _codec(content, pattern)
        for part in parts:
            yield part | {"decoded": [None if ids is None else codec.decode(ids) for ids in part["ids"]]}

    return map_slices(coded.select("doc_id", "ids"), "doc_id long, ids binary, decoded binary", work)
