"""N-gram Jaccard self-join of documents, exact, with set relations used to skip work.

Sets are the distinct hashed 5-word shingles of whole texts. Documents with one set are
one set from the start.

1. Relations. A few minhash values name, for every set, one likely similar set (the least
   of those with the same value): a star, never all pairs. The overlaps are computed
   exactly; sets that link are one component, and the overlap with its pivot tells how much
   a set differs from it.
2. Index. The tokens of a set are ordered from rare to common (counts of all documents, in
   a table of fixed size). Two sets that link share a token in their prefixes. Postings are
   narrow rows that Spark sorts by token, set size and place, and each task reads its lists
   in a stream. Within a list a partner is skipped when its size or the places of the token
   or a small parity sketch (16 bytes) rule a link out, and sets of one component skip each other. Long lists are cut into
   blocks; a pair of blocks whose sizes, places or components leave no link is skipped as a
   whole, and those that are left are rows that Spark spreads.
3. Answers. The index names pairs of pivots, not of sets, so a set that is close to a large
   group of similar sets meets it once. The overlap of two pivots bounds that of their sets
   to within what these have beyond them; parity sketches (256 bytes a set) bound it before
   it is computed. That decides most groups as a whole. What is left is computed itself.

Every link is decided by the exact overlap of whole sets or by bounds that prove it. Hashes
are 64 bits; two different shingles of one pair of documents would have to collide to
change an overlap by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, small_batches, stamp, text_or_empty
from millrace.llm.hashing import Rolling, bit_table, held, in_table, maybe_in, mix
from millrace.sources.tables import discard, materialise

WORDS = 5
#: Links need an intersection of at least SHARE of SCALE parts of the union.
SHARE, SCALE = 75, 100
BANDS, BAND_ROWS = 6, 2
COUNTERS = 1 << 21
#: Bits of the parity sketch of a set.
PARITY = 2048
#: Bits of the one that goes with every posting.
SMALL_PARITY = 128
COUNT_SLICES = 64
SUM_ROWS = 256
#: Texts are cut into shingles in stretches of about this many bytes.
CHUNK_BYTES = 1 << 19
#: Entries of a block of a token's list.
BLOCK_ENTRIES = 256
#: A set in a block of a pivot's sets; ``gain`` is what it adds to the bound of its links.
MEMBER = np.dtype([("key", "<i8"), ("n", "<i8"), ("gain", "<i8"), ("parity", "<u8", PARITY // 64)])
MULTIPLIERS = mix(np.arange(1, 64, dtype="uint64")) | np.uint64(1)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles: of ``words`` neighbouring words, A-Z
    in lower case; of all words where there are fewer; none without words."""
    out: list[np.ndarray] = []
    chunk, size = [], 0
    for text in texts:
        chunk.append(text.encode("utf-8", "replace"))
        size += len(chunk[-1])
        if size > CHUNK_BYTES:
            out += _chunk_sets(chunk, words)
            chunk, size = [], 0
    return out + _chunk_sets(chunk, words)


def _chunk_sets(raws: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(raws) + b"\n", "uint8")
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype("uint8")
    blank = (data == 32) | (data >= 9) & (data <= 13)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank]).astype("int8")))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.zeros(0, "uint64") for _ in raws]
    word = Rolling(data).of(starts, ends)
    bounds = np.cumsum([0] + [len(r) + 1 for r in raws])
    first = np.searchsorted(starts, bounds)
    n = len(word) - words + 1
    joined = np.zeros(max(n, 0), "uint64")
    for k in range(words if n > 0 else 0):
        joined += word[k : k + n] * MULTIPLIERS[k]
    joined = mix(joined)
    out = []
    for a, b in zip(first, first[1:]):
        if b - a >= words:
            out.append(np.unique(joined[a : b - words + 1]))
        elif b > a:
            few = (word[a:b] * MULTIPLIERS[: b - a]).sum(dtype="uint64") + np.uint64(b - a)
            out.append(mix(np.array([few], "uint64")))
        else:
            out.append(np.zeros(0, "uint64"))
    return out


def _set_keys(tokens: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    return tuple(
        int(mix(np.array([mix(tokens ^ np.uint64(salt)).sum(dtype="uint64")], "uint64")).view("int64")[0])
        for salt in (0x51ED270B, 0x2545F491)
    )


def _bands(tokens: np.ndarray) -> list[int]:
    least = [mix(tokens * MULTIPLIERS[40 + k]).min() for k in range(BANDS * BAND_ROWS)]
    packed = np.array(least, "uint64").reshape(BANDS, BAND_ROWS)
    return mix((packed * MULTIPLIERS[:BAND_ROWS]).sum(1, dtype="uint64")).view("int64").tolist()


def _parity(tokens: np.ndarray, bits: int = PARITY) -> bytes:
    """One bit for each of ``bits`` classes of tokens: whether the set has an odd number of
    them. Two sets differ by at least as many tokens as their sketches differ by bits."""
    odd = np.bincount((tokens >> np.uint64(20)).astype("int64") % bits, minlength=bits) & 1
    return np.packbits(odd.astype("uint8")).tobytes()


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(40)).astype("int64") & (COUNTERS - 1)


def describe(docs: DataFrame, words: int) -> DataFrame:
    """One row for each document (``doc_id, t, n, key, key2, bands, parity``) and, from each task,
    its counts of tokens in slices (``slice, task, counts``); ``slice`` is -1 for documents."""
    schema = "doc_id long, t long, n long, key long, key2 long, bands array<long>, parity binary, slice long, task long, counts binary"

    def work(parts: Iterator[dict]) -> Iterator[dict]:
        counts, task = np.zeros(COUNTERS, "int32"), 0
        for part in parts:
            sets = shingle_sets(part["text"], words)
            keys = [_set_keys(tokens) if len(tokens) else (0, 0) for tokens in sets]
            for t, tokens in zip(part["t"], sets):
                task ^= t & 0xFFFFFFFF
                np.add.at(counts, _slot(tokens), 1)
            rows = len(sets)
            yield {
                "doc_id": part["doc_id"], "t": part["t"], "n": [len(tokens) for tokens in sets],
                "key": [k for k, _ in keys], "key2": [k for _, k in keys],
                "bands": [_bands(tokens) if len(tokens) else [] for tokens in sets],
                "parity": [_parity(tokens) for tokens in sets],
                "slice": [-1] * rows, "task": [0] * rows, "counts": [b""] * rows,
            }
        slices = np.split(counts, COUNT_SLICES)
        full = [i for i, part in enumerate(slices) if part.any()]
        none = [0] * len(full)
        yield {
            "doc_id": none, "t": none, "n": none, "key": none, "key2": none, "bands": [[]] * len(full), "parity": [b""] * len(full),
            "slice": full, "task": [task] * len(full), "counts": [slices[i].tobytes() for i in full],
        }

    return map_slices(docs, schema, work)


def rarity(parts: DataFrame) -> np.ndarray:
    """The counters summed over all tasks, a bounded number of tasks at a time."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, "uint32").astype("int64") for c in group["counts"])
        total = np.minimum(total, 0xFFFFFFFF).astype("uint32")
        return pd.DataFrame({"slice": [group["slice"].iloc[0]], "task": [int(group["task"].iloc[0])], "counts": [total.tobytes()]})

    schema = "slice long, task long, counts binary"
    rows = parts.where("slice >= 0").select("slice", "task", "counts")
    left = rows.groupBy("slice").count().agg(F.max("count")).first()[0] or 0
    while left > 1:
        groups = -(-left // SUM_ROWS)
        salt = F.pmod(F.xxhash64("task", F.lit(groups)), F.lit(groups)) if groups > 1 else F.lit(0)
        rows = materialise(rows.groupBy("slice", salt.alias("salt")).applyInPandas(add, schema), "counts")
        left = groups
    counts = np.zeros(COUNTERS, "uint32")
    width = COUNTERS // COUNT_SLICES
    for r in rows.toLocalIterator():
        counts[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["counts"], "uint32")
    return counts


def _text_of(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``sets`` (``key, place`` and more) with the text of the document at ``place``."""
    mark = F.xxhash64("doc_id", "t")
    thin = docs.where(maybe_in(sets, F.xxhash64("place.doc_id", "place.t"), mark))
    texts = thin.select(F.coalesce("doc_id", F.lit(0)).alias("_d"), F.col("doc_id").isNull().alias("_n"), F.col("t").alias("_t"), "text")
    place = sets.withColumn("_p", F.coalesce("place.doc_id", F.lit(0))).withColumn("_q", F.col("place.doc_id").isNull())
    met = place.join(texts, (F.col("_p") == F.col("_d")) & (F.col("_q") == F.col("_n")) & (F.col("place.t") == F.col("_t")))
    return met.drop("_p", "_q", "_d", "_n", "_t")


def overlaps(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``a, b, o, na, nb`` for each pair of set keys: the exact size of the intersection and of
    the sets. Stored."""
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = materialise(sets.select("key", "place").join(keys, "key"), "pair-sets")
    texts = materialise(_text_of(wanted, docs).select("key", "text").dropDuplicates(["key"]), "pair-texts")
    met = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    met = met.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b")

    def count(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            a, b = part["a"], part["b"]
            texts = dict(zip(a, part["ta"])) | dict(zip(b, part["tb"]))
            found = dict(zip(texts, shingle_sets(list(texts.values()), words)))
            o = [len(np.intersect1d(found[x], found[y], assume_unique=True)) for x, y in zip(a, b)]
            yield {"a": a, "b": b, "o": o, "na": [len(found[x]) for x in a], "nb": [len(found[y]) for y in b]}

    schema = "a long, b long, o long, na long, nb long"
    return materialise(map_slices(met.select("a", "b", "ta", "tb"), schema, count), "overlaps")


def sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a, b`` of ``pairs``, with ``na, nb, gain``) for which the parity sketches of
    ``sets`` (``key, n, gain, parity``) leave an overlap that reaches a link together with the
    two gains: SCALE + SHARE times the overlap plus them is not negative. Sizes, gains and
    sketches come with one join a side."""
    met = pairs.select("a", "b")
    for side, parity in (("a", "x"), ("b", "y")):
        met = met.join(sets.toDF(side, f"n{side}", f"g{side}", parity), side)
    met = met.withColumn("gain", F.col("ga") + F.col("gb"))

    def keep(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            x, y = (np.frombuffer(b"".join(part[c]), "uint8").reshape(-1, PARITY // 8) for c in ("x", "y"))
            differ = np.bitwise_count(x ^ y).sum(1, dtype="int64")
            both = np.array(part["na"]) + np.array(part["nb"])
            kept = np.flatnonzero((both - differ) * (SCALE + SHARE) + 2 * np.array(part["gain"]) >= 0)
            yield {c: [part[c][i] for i in kept] for c in ("a", "b", "na", "nb", "gain")}

    return map_slices(met.select("a", "b", "na", "nb", "gain", "x", "y"), "a long, b long, na long, nb long, gain long", keep)


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a, b``) that the parity sketches do not rule out."""
    return sketched(pairs, sets.select("key", "n", (-F.lit(SHARE) * F.col("n")).alias("gain"), "parity")).drop("gain")


def _links(o: Column, na: Column, nb: Column) -> Column:
    return o * (SCALE + SHARE) >= (na + nb) * SHARE


def components(links: DataFrame) -> DataFrame:
    """``key, label`` of the nodes of ``links`` (``a, b``): the same label for all that are
    connected. Each round maps every node to the least of its neighbourhood and goes on with
    the graph of those; keys are hashes, so rounds shrink the graph whatever its shape."""
    edges = materialise(links.select("a", "b").where("a <> b"), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        least = materialise(least.select(F.col("a").alias("key"), "to"), "labels")
        steps.append(least)
        left, right = least.toDF("a", "x"), least.toDF("b", "y")
        near = edges.join(left, "a").join(right, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = materialise(near.where("a <> b").distinct(), "edges")
    if not steps:
        return links.select(F.col("a").alias("key"), F.col("a").alias("label")).limit(0)
    labels = steps[0].select("key", F.col("to").alias("label"))
    for step in steps[1:]:
        further = step.select(F.col("key").alias("label"), "to")
        labels = labels.join(further, "label", "left").select("key", F.coalesce("to", "label").alias("label"))
    return materialise(labels, "components")


def postings(rows: DataFrame, common: np.ndarray, words: int, aside: np.ndarray) -> DataFrame:
    """Prefix tokens of the sets of ``rows`` (``pivot, comp, text, mark``), a row each: the token, the
    size of the set and the place of the token in it (``rank``, one number), the set's pivot
    and component, and a small parity sketch of the set (``s0, s1``). A null pivot is that of
    a set on its own and is computed here, unless the row's ``mark`` is in the bit table ``aside``:
    such rows come a second time with their pivot. A filter before would take a second Python
    worker for each task."""

    def spread(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            known = held(aside, np.array(part["mark"], "int64"))
            kept = [i for i, pivot in enumerate(part["pivot"]) if pivot is not None or not known[i]]
            sets, of = [], shingle_sets([part["text"][i] for i in kept], words)
            for pivot, comp, tokens in zip(*([part[c][i] for i in kept] for c in ("pivot", "comp")), of):
                size = len(tokens)
                if not size:
                    continue
                if pivot is None:
                    pivot = comp = _set_keys(tokens)[0]
                order = np.lexsort((tokens, common[_slot(tokens)]))[: size - math.ceil(size * SHARE / SCALE) + 1]
                sketch = np.frombuffer(_parity(tokens, SMALL_PARITY), "<i8")
                sets.append((tokens[order].view("int64"), size, pivot, comp, *sketch.tolist()))
            if sets:
                length = [len(t) for t, *_ in sets]
                size, *others = (np.repeat(np.array(c, "int64"), length) for c in list(zip(*sets))[1:])
                place = np.concatenate([np.arange(n) for n in length])
                columns = (np.concatenate([t for t, *_ in sets]), size << 32 | place, *others)
                yield dict(zip(("token", "rank", "pivot", "comp", "s0", "s1"), columns))

    return map_slices(rows.select("pivot", "comp", "text", "mark"), "token long, rank long, pivot long, comp long, s0 long, s1 long", spread)


def _may_link(size_x, size_y, place_x, place_y) -> np.ndarray:
    """Whether the places of a first common token leave enough to link."""
    most = 1 + np.minimum(size_x - 1 - place_x, size_y - 1 - place_y)
    return most * (SCALE + SHARE) >= (size_x + size_y) * SHARE


def _alike(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Whether the small sketches of two sets allow a link: the sets differ by at least as many
    tokens as these by bits. ``x`` and ``y``: sizes and the two halves of the sketches."""
    differ = sum(np.bitwise_count((a ^ b).view("uint64")).astype("int64") for a, b in zip(x[1:], y[1:]))
    both = x[0] + y[0]
    return (both - differ) * (SCALE + SHARE) >= 2 * both * SHARE


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)


def _within(columns: list[np.ndarray]) -> np.ndarray:
    """Pairs of pivots from lists in the order of token and size: partners one step further
    each time; an entry stops at the first partner that is too large for it, or when its
    place leaves too little for any."""
    token, size, place, pivot, comp, *sketch = columns
    # the smaller set has the larger part of itself in common: its prefix is shorter
    early = place * (SCALE + SHARE) <= size * (SCALE - SHARE)
    at, step, found = np.flatnonzero(early), 1, [np.zeros((0, 2), "int64")]
    while len(at):
        at = at[at + step < len(token)]
        y = at + step
        goes_on = (token[at] == token[y]) & (size[at] * SCALE >= size[y] * SHARE)
        at, y = at[goes_on], y[goes_on]
        hit = (comp[at] != comp[y]) & _may_link(size[at], size[y], place[at], place[y])
        i, j = at[hit], y[hit]
        near = _alike([c[i] for c in (size, *sketch)], [c[j] for c in (size, *sketch)])
        if near.any():
            found.append(_pairs(pivot[i[near]], pivot[j[near]]))
        step += 1
    return np.unique(np.concatenate(found), axis=0)


def _across(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Pairs of pivots between two blocks of one list, ``x`` before ``y``."""
    (size, place, _, comp, *_), other = ([c[:, None] for c in x], [c[None, :] for c in y])
    hit = (comp != other[3]) & (size * SCALE >= other[0] * SHARE) & _may_link(size, other[0], place, other[1])
    i, j = np.nonzero(hit)
    near = _alike([x[c][i] for c in (0, 4, 5)], [y[c][j] for c in (0, 4, 5)])
    return _pairs(x[2][i[near]], y[2][j[near]])


LISTED = pa.schema([
    ("a", pa.int64()), ("b", pa.int64()), ("token", pa.int64()), ("no", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
    ("early", pa.int64()), ("comp_low", pa.int64()), ("comp_high", pa.int64()), ("entries", pa.binary()),
])
LISTED_DDL = ", ".join(f"{f.name} {'binary' if f.name == 'entries' else 'long'}" for f in LISTED)


def read_lists(sorted_postings: DataFrame, block: int) -> DataFrame:
    """Reads postings sorted by token and rank. Lists of up to ``block`` entries give
    pairs of pivots at once. Longer ones are cut into blocks: each gives the pairs within it,
    and a row of its own with the bounds that let a pair of blocks be skipped (sizes, earliest
    place, components). A task holds a batch and the part of a list that is not yet a block."""

    def rows(pairs: np.ndarray, blocks: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(pairs):
            empty = [None] * len(pairs)
            columns = {"a": pairs[:, 0], "b": pairs[:, 1]} | {f: empty for f in LISTED.names[2:]}
            yield pa.RecordBatch.from_pydict(columns, LISTED)
        if blocks:
            columns = dict(zip(LISTED.names, [[None] * len(blocks)] * 2 + [list(c) for c in zip(*blocks)]))
            yield pa.RecordBatch.from_pydict(columns, LISTED)

    def described(token: int, no: int, columns: list[np.ndarray]) -> tuple:
        _, size, place, _, comp, *_ = columns
        bounds = (size.min(), size.max(), place.min(), comp.min(), comp.max())
        return (token, no, *map(int, bounds), np.stack(columns[1:]).astype("<i8").tobytes())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, no = [np.zeros(0, "int64")] * 7, 0  # of the last token so far; blocks it had
        for last, batch in _with_end(batches):
            if batch is not None:
                token, rank, *others = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                fresh = (token, rank >> 32, rank & 0xFFFFFFFF, *others)
                held = [np.concatenate([h, c]) for h, c in zip(held, fresh)]
            token = held[0]
            if not len(token):
                continue
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            ends = np.append(starts[1:], len(token))
            blocks, pairs, short = [], [], np.ones(len(token), bool)
            for start, end in zip(starts.tolist(), ends.tolist()) if no or (ends - starts).max() > block else ():
                own_no = no if start == 0 else 0
                ongoing = end == len(token) and not last
                if not own_no and end - start <= block:
                    continue
                short[start:end] = False
                at = start
                while end - at > block or at < end and not ongoing:
                    part = [c[at : min(end, at + block)] for c in held]
                    blocks.append(described(int(token[start]), own_no, part))
                    pairs.append(_within(part))
                    at, own_no = at + len(part[0]), own_no + 1
                if ongoing:
                    keep, kept_no = at, own_no
            if last:
                keep, kept_no = len(token), 0
            elif short[starts[-1]]:
                keep, kept_no = int(starts[-1]), 0
            short[keep:] = False
            pairs.append(_within([c[short] for c in held]))
            yield from rows(np.unique(np.concatenate(pairs), axis=0), blocks)
            held, no = [c[keep:] for c in held], kept_no

    return sorted_postings.mapInArrow(read, LISTED_DDL)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs of pivots from different blocks of one list; pairs of blocks whose bounds leave no
    link are never made, and each that is left is a row of its own."""
    names = ["no", "low", "high", "early", "comp_low", "comp_high", "entries"]
    x, y = (blocks.select("token", *[F.col(n).alias(f"{n}_{side}") for n in names]) for side in "xy")
    one = (F.col("comp_low_x") == F.col("comp_high_y")) & (F.col("comp_high_x") == F.col("comp_low_y"))
    met = x.join(y, "token").where(
        (F.col("no_x") < F.col("no_y"))
        & (F.col("high_x") * SCALE >= F.col("low_y") * SHARE)
        & (F.col("early_x") * (SCALE + SHARE) <= F.col("high_x") * (SCALE - SHARE))
        & ~one
    )

    def compare(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            found = [np.zeros((0, 2), "int64")]
            for x, y in zip(part["entries_x"], part["entries_y"]):
                found.append(_across(*(list(np.frombuffer(e, "<i8").reshape(6, -1)) for e in (x, y))))
            pairs = np.unique(np.concatenate(found), axis=0)
            yield {"a": pairs[:, 0], "b": pairs[:, 1]}

    spread = met.repartition("token", "no_x", "no_y")
    return map_slices(spread.select("entries_x", "entries_y"), "a long, b long", compare)


def jaccard_components(
    docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_same, t`` for each row of ``docs``.

    ``n_shingles`` is the size of the document's set, ``component_id`` the smallest id that
    is reachable by links, its own included, ``n_same`` the number of rows with the same
    set, ``t`` the stamp of the text. Null texts and texts without words have an empty set and no links: they are their
    own component, and ``n_same`` is null. Repeated rows have one set and stay repeated; a
    row without an id belongs to its component, whose smallest id is null if no row has one.
    Other columns are not read.
    """
    with small_batches(docs.sparkSession):
        return _components(docs, words, id_col, text_col)


def _components(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    stamped = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), stamp(text_col).alias("t"))
    described = materialise(describe(stamped, words), "shingle-sets")
    listed = described.where("slice < 0")
    place = F.struct("doc_id", "t")
    sets = listed.where("n > 0").groupBy("key").agg(
        F.min(place).alias("place"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_same"),
        F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("parity").alias("parity"),
        F.when(F.min("key2") != F.max("key2"), F.raise_error(F.lit("two sets share a key"))).alias("clash"),
    )
    sets = materialise(sets.where("clash IS NULL").drop("clash"), "distinct-sets")

    # 1. relations
    band = sets.select("key", F.posexplode("bands").alias("band", "value"))
    pivots = band.groupBy("band", "value").agg(F.min("key").alias("pivot"), F.count(F.lit(1)).alias("k")).where("k > 1")
    star = band.join(pivots, ["band", "value"]).where("key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    known = overlaps(possible(star.distinct(), sets), sets, stamped, words)
    linked = known.where(_links(F.col("o"), F.col("na"), F.col("nb")))
    first = components(linked)
    closest = linked.groupBy(F.col("a").alias("key")).agg(F.max(F.struct("o", "b")).alias("best"))
    closest = materialise(closest.select("key", F.col("best.b").alias("pivot"), F.col("best.o").alias("shared")), "pivots")

    # 2. index, 3. answers
    groups = sets.join(first, "key", "left").join(closest, "key", "left").select(
        "key", "place", "n_same", "n", F.coalesce("label", "key").alias("comp"), F.coalesce("pivot", "key").alias("pivot"),
        (F.col("n") - F.coalesce("shared", "n")).alias("beyond"), F.col("label").isNotNull().alias("related"),
    )
    groups = materialise(groups, "groups")
    found = _indexed(listed, groups, stamped, rarity(described), words)
    more = _answers(found, groups, sets, stamped, words)
    links = linked.select("a", "b").unionByName(more)
    first = components(links)
    named = sets.select("key", "least_id", "n_same").join(first, "key", "left").withColumn("label", F.coalesce("label", "key"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "label").select("key", "component_id", "n_same")
    out = listed.select("doc_id", F.col("n").alias("n_shingles"), "key", "t").join(named, "key", "left")
    own_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own_id.alias("component_id"), "n_same", "t")


def _indexed(listed: DataFrame, groups: DataFrame, docs: DataFrame, common: np.ndarray, words: int) -> DataFrame:
    """Pairs ``a, b`` of pivots for which sets of different components share a prefix token.
    Only documents of sets that have a component or several documents are joined with their
    group; the others are their own. Stored."""
    several = materialise(groups.where("related OR n_same > 1").select("key", "place", "comp", "pivot"), "related-sets")
    mark = F.xxhash64("doc_id", "t")
    known_docs = listed.where("n > 0").join(several.select("key"), "key", "left_semi").select("doc_id", "t")
    aside = bit_table(known_docs, mark)
    own = _text_of(groups.select("key", "place", "comp", "pivot"), docs.where(in_table(aside, mark)))
    none = F.lit(None).cast("long")
    alone = docs.select(none.alias("pivot"), none.alias("comp"), "text", mark.alias("mark"))
    own = own.select("pivot", "comp", "text", F.lit(0).cast("long").alias("mark"))
    rows = postings(alone.unionByName(own), common, words, aside)
    ordered = rows.repartition("token").sortWithinPartitions("token", "rank", "pivot")
    lists = materialise(read_lists(ordered, BLOCK_ENTRIES), "lists")
    pairs = lists.where("a IS NOT NULL").select("a", "b")
    blocks = lists.where("a IS NULL").drop("a", "b")
    if not blocks.isEmpty():
        pairs = pairs.unionByName(block_pairs(blocks))
    pairs = materialise(pairs.distinct(), "pivot-pairs")
    discard(lists)
    return pairs


def member_blocks(members: DataFrame) -> DataFrame:
    """The sets ``members`` (``pivot, key, n, gain, parity``) packed into blocks of one pivot,
    by falling gain: ``pivot, first, top`` (a key and the largest gain of the block) ``, entries``.
    A pivot of very many sets is spread over tasks."""

    def pack(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            pivot, rows = np.array(part["pivot"], "int64"), np.zeros(len(part["key"]), MEMBER)
            for name in ("key", "n", "gain"):
                rows[name] = part[name]
            rows["parity"] = np.frombuffer(b"".join(part["parity"]), "<u8").reshape(-1, PARITY // 64)
            starts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
            blocks = np.split(rows, starts[1:])
            yield {
                "pivot": pivot[starts], "first": rows["key"][starts], "top": [int(b["gain"].max()) for b in blocks],
                "entries": [b.tobytes() for b in blocks],
            }

    ordered = members.repartitionByRange("pivot", F.desc("gain"), "key").sortWithinPartitions("pivot", F.desc("gain"), "key")
    return map_slices(ordered, "pivot long, first long, top long, entries binary", pack)


def member_pairs(open_: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b, na, nb`` of a set of pivot p and one of pivot q for the pairs ``open_``
    (``p, q``, their overlap ``o``), but the pivots themselves: all whose gains and sketches
    leave a link. What is joined are blocks of sets; blocks whose best gains leave no link
    never meet. In two that meet, each set is held against the sketch of the other pivot first,
    and only the sets left on both sides are compared with each other."""
    whole = SCALE + SHARE
    asked = open_.select(F.col("p").alias("pivot")).unionByName(open_.select(F.col("q").alias("pivot"))).distinct()
    gain = whole * F.col("beyond") - SHARE * F.col("n")
    members = groups.join(asked, "pivot", "left_semi").select("pivot", "key", "n", gain.alias("gain"))
    members = materialise(members.join(sets.select("key", "parity"), "key"), "open-members")
    blocks = materialise(member_blocks(members), "member-blocks")
    met = open_.select("p", "q", (whole * F.col("o")).alias("bound"))
    for side in "pq":
        met = met.join(sets.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"parity_{side}")), side)
        met = met.join(blocks.toDF(side, f"first_{side}", f"top_{side}", f"entries_{side}"), side)
        met = met.where(F.col("bound") + F.col("top_p") + F.col("top_q") >= 0) if side == "q" else met

    def shared(x: np.ndarray, n: int, parity: np.ndarray) -> np.ndarray:
        """Twice the most that sets can share with one of ``n`` tokens."""
        return x["n"] + n - np.bitwise_count(x["parity"] ^ parity).sum(1, dtype="int64")

    def facing(x: np.ndarray, n: int, parity: bytes, top: int) -> np.ndarray:
        """Those of ``x`` that may link with a set of the other pivot."""
        return x[shared(x, n, np.frombuffer(parity, "<u8")) * whole - 2 * SHARE * x["n"] + 2 * top >= 0]

    columns = ["p", "q", "bound", *(f"{c}_{side}" for side in "pq" for c in ("n", "parity", "top", "entries"))]

    def compare(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            found = [np.zeros((4, 0), "int64")]
            for p, q, bound, n_p, parity_p, top_p, entries_p, n_q, parity_q, top_q, entries_q in zip(*(part[c] for c in columns)):
                few = facing(np.frombuffer(entries_p, MEMBER), n_q, parity_q, top_q)
                many = facing(np.frombuffer(entries_q, MEMBER), n_p, parity_p, top_p)
                turned = len(few) > len(many)
                if turned:
                    few, many = many, few
                for x in few:
                    y = many[bound + x["gain"] + many["gain"] >= 0]
                    y = y[shared(y, x["n"], x["parity"]) * whole >= 2 * SHARE * (x["n"] + y["n"])]
                    own = np.full(len(y), x["key"]), y["key"], np.full(len(y), x["n"]), y["n"]
                    a, b, na, nb = (own[i] for i in ((1, 0, 3, 2) if turned else (0, 1, 2, 3)))
                    found.append(np.stack([a, b, na, nb])[:, (a != p) | (b != q)])
            yield dict(zip(("a", "b", "na", "nb"), np.concatenate(found, axis=1)))

    spread = met.repartition("first_p", "first_q", "p", "q")
    return map_slices(spread.select(*columns), "a long, b long, na long, nb long", compare)


def _answers(pairs: DataFrame, groups: DataFrame, sets: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Links ``a, b`` that connect the sets of the pivot pairs, as far as components go.

    For x of pivot p and y of pivot q the overlap is at most that of p and q plus what x and
    y have beyond p and q. The largest such gain of each pivot's sets bounds all their pairs
    together: first with the overlap that the sketches of p and q allow, then with their
    exact one. Pivots that link connect their sets and components. Of the others, those that
    are still in different components go on: their sets are compared in blocks, and those
    whose own gain and sketches still allow a link are decided by their exact overlap."""
    whole, share = F.lit(SCALE + SHARE), F.lit(SHARE)
    gain = groups.groupBy(F.col("pivot").alias("key")).agg(F.max(whole * F.col("beyond") - share * F.col("n")).alias("gain"))
    pivots = materialise(sets.select("key", "n", "parity").join(gain, "key").select("key", "n", "gain", "parity"), "pivot-gains")
    asked = materialise(sketched(pairs, pivots), "asked-pivots")
    known = overlaps(asked, sets, docs, words).join(asked.select("a", "b", "gain"), ["a", "b"])
    linked = _links(F.col("o"), F.col("na"), F.col("nb"))
    for side in ("a", "b"):
        known = known.join(groups.select(F.col("key").alias(side), F.col("comp").alias(f"c{side}")), side)
    known = materialise(known, "known-pivots")
    merged = components(known.where(linked).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    for side in ("a", "b"):
        known = known.join(merged.select(F.col("key").alias(f"c{side}"), F.col("label").alias(f"l{side}")), f"c{side}", "left")
    apart = F.coalesce("la", "ca") != F.coalesce("lb", "cb")
    open_ = known.where(~linked & apart & (whole * F.col("o") + F.col("gain") >= 0))
    open_ = open_.select(F.col("a").alias("p"), F.col("b").alias("q"), "o")
    left = materialise(member_pairs(open_, groups, sets), "candidates")
    exact = overlaps(left, sets, docs, words)
    exact = exact.where(_links(F.col("o"), F.col("na"), F.col("nb")))
    return known.where(linked).select("a", "b").unionByName(exact.select("a", "b"))
