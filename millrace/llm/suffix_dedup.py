"""Suffix-array dedup: bytes covered by strings of a minimum length that occur elsewhere.

1. Anchors. Of all ``GRAM``-byte strings in a window of ``min_bytes`` bytes the one with
   the smallest hash is the window's anchor, so equal windows have equal anchors, wherever
   they stand. The neighbouring windows that share an anchor make a segment (some hundred
   bytes longer than a window). A segment is a narrow row: hash of the anchor, hash of
   the segment, place.
2. Segments are counted by (anchor, segment). Equal segments repeat as a whole. An anchor
   with one segment is done. Anchors with several different segments are open: their
   segments agree in part at most.
3. The bytes of open segments (one copy of each) meet in buckets of anchors. A bucket is
   sorted as suffixes up to ``min_bytes`` deep, by doubling the compared length, equal
   suffixes in text order. The previous smaller position of a suffix is then its left
   neighbour: if both are equal, it is the longest-previous-factor match, and the
   neighbour on the right is the next one. Windows with an earlier (or any) match repeat.
4. Repeating windows become spans of their documents.

Where a number of words is given too, strings of that many words repeat even if they have
fewer bytes: each such string is a narrow row of its own, counted by two hashes.

Copies cost one narrow row each. The windows of an anchor with more than
``OPEN_SEGMENTS`` different segments, such as the edges of a passage in very many
documents, are counted by their own hashes in a distributed count instead of in one
bucket, with the same result; runs of windows that repeat, or cannot, are counted as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, small_batches, text_or_empty
from millrace.llm.hashing import CHUNK_BYTES, Rolling, maybe_in, mix
from millrace.plans.ordered import join_null_safe
from millrace.sources.tables import materialise

MIN_BYTES = 400
#: Windows a task hashes at one time.
HELD_WINDOWS = 100_000
OPEN_SEGMENTS = 1_024
#: Neighbouring windows of a hot anchor's segment that are looked at together.
STRIDE = 16
BUCKET_SEGMENTS = 1_500
#: Bytes that are white space between words, and those of letters and digits.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LETTER = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` numbers, from running minima of blocks."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo("uint64").max, "uint64")]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    np.minimum.accumulate(padded[:, ::-1], axis=1, out=padded[:, ::-1])
    return np.minimum(padded.ravel()[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, bounds: np.ndarray, min_bytes: int, gram: int) -> tuple[np.ndarray, ...]:
    """``anchor, segment, start, size`` of the segments of texts that lie one after the
    other in ``data``; ``bounds``: where each begins, and the end."""
    none = np.zeros(0, "int64")
    if len(data) < min_bytes:
        return none, none, none, none
    # An array here has eight bytes for each byte of text: none is kept longer than it is needed.
    rolling = Rolling(data)
    grams = rolling.each(gram)
    low = np.uint64((1 << 32) - 1)
    order = mix(grams ^ low)
    order &= ~low
    order |= np.arange(len(order), dtype="uint64")
    chosen = _sliding_least(order, min_bytes - gram + 1)
    del order
    chosen = (chosen & low).astype("int32")
    text = np.repeat(np.arange(len(bounds) - 1, dtype="int32"), np.diff(bounds))
    valid = text[: len(chosen)] == text[min_bytes - 1 :]
    del text
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    closes = np.ones(len(chosen), bool)
    closes[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(closes & valid)
    end = last + min_bytes
    return grams[chosen[first]].view("int64"), rolling.of(first, end).view("int64"), first, end - first


def _pieces(texts: list[str], min_bytes: int) -> Iterator[tuple[list[tuple[int, int]], bytes, list[int]]]:
    """Chunks of whole texts; a text longer than a chunk comes in pieces that overlap by a
    window less a byte. Each piece: number of its text, place in the text."""
    owners, parts, size = [], [], 0
    for number, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        for begin in range(0, max(1, len(raw) - min_bytes + 1), CHUNK_BYTES):
            part = raw[begin : begin + CHUNK_BYTES + min_bytes - 1]
            if len(part) < min_bytes:
                continue
            owners.append((number, begin))
            parts.append(part)
            size += len(part)
            if size >= CHUNK_BYTES:
                yield owners, b"".join(parts), [len(p) for p in parts]
                owners, parts, size = [], [], 0
    if parts:
        yield owners, b"".join(parts), [len(p) for p in parts]


def flagged(rows: DataFrame) -> DataFrame:
    """Null ids as 0 with a flag ``none``: pandas would make numbers beside nulls inexact."""
    return rows.withColumn("none", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))


def find_segments(texts: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """``doc_id, t, anchor, segment, start, size`` of all windows of ``texts`` (``doc_id``,
    ``t``, ``text``)."""

    def find(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            ids, marks = part["doc_id"], part["t"]
            for owners, raw, sizes in _pieces(part["text"], min_bytes):
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                anchor, segment, start, size = segments(np.frombuffer(raw, "uint8"), bounds, min_bytes, gram)
                piece = np.searchsorted(bounds, start, "right") - 1
                number = np.array([n for n, _ in owners])[piece].tolist()
                begin = np.array([b for _, b in owners])[piece]
                yield {
                    "doc_id": [ids[n] for n in number], "t": [marks[n] for n in number], "anchor": anchor,
                    "segment": segment, "start": begin + start - bounds[piece], "size": size,
                }

    schema = "doc_id long, t long, anchor long, segment long, start long, size long"
    return map_slices(texts.select("doc_id", "t", "text"), schema, find)


def repeated_windows(parts: list[bytes], min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of the windows of ``parts``: for each window that has an equal one,
    (part, place in it, whether an equal window stands earlier). Parts are in text order."""
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts) + bytes(8), "uint8").astype("uint64")
    ends = np.repeat(np.cumsum(sizes), sizes)
    n = len(ends)
    key = np.zeros(n, "uint64")
    for i in range(8):
        key = key << np.uint64(8) | data[i : n + i]
    at = np.flatnonzero(ends - np.arange(n) >= 8)
    rank = np.full(n, -1, "int64")  # -1: no equal string of this length
    depth = 8
    rank[at] = _ranks(key[at])
    at = at[rank[at] >= 0]
    while depth < min_bytes and len(at):
        step = min(depth, min_bytes - depth)
        at = at[ends[at] - at >= depth + step]
        after = rank[at + step]
        at, after = at[after >= 0], after[after >= 0]
        merged = _ranks(rank[at] * np.int64(n) + after)
        rank = np.full(n, -1, "int64")
        rank[at] = merged
        at = at[merged >= 0]
        depth += step
    order = at[np.lexsort((at, rank[at]))]
    earlier = np.zeros(len(order), bool)
    earlier[1:] = rank[order[1:]] == rank[order[:-1]]
    part = np.repeat(np.arange(len(parts)), sizes)[order]
    return part, order - (np.cumsum(sizes) - sizes)[part], earlier


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Number of each key in order; -1 for keys that occur once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    alone = new.copy()
    alone[:-1] &= new[1:]
    out = np.empty(len(keys), "int64")
    out[order] = np.where(alone, -1, np.cumsum(new) - 1)
    return out


def _stamped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))


def repeated_spans(
    docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, t, begin, end``: byte spans of the UTF-8 texts that are covered by strings
    of ``min_bytes`` bytes that also start elsewhere, in the same text or another. Spans of
    one text may overlap. ``t`` is the xxhash64 of the text, which tells apart documents
    with one id.

    ``keep_first``: only strings with an earlier start count (order of id, then place), so
    that the first copy stays; a null id comes first. Repeated rows are copies of each
    other, and the first copy is then in each of them. Null texts are empty and have no
    spans, nor have texts shorter than ``min_bytes``. Other columns are not read.
    """
    gram = max(1, min(48, min_bytes // 4))
    texts = _stamped(docs, id_col, text_col)
    with small_batches(docs.sparkSession):
        found = materialise(find_segments(texts.where(F.octet_length("text") >= min_bytes), min_bytes, gram), "segments")
    place = F.struct("doc_id", "t", "start", "size")
    kinds = found.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    kinds = materialise(kinds, "segment-kinds")
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    open_ = materialise(kinds.join(several, "anchor"), "open-segments")
    with small_batches(docs.sparkSession):
        bytes_ = _bytes_of(open_, texts, min_bytes)
        windows = _compare(bytes_.where(F.col("kinds") <= OPEN_SEGMENTS), min_bytes, open_).unionByName(
            _count_windows(bytes_.where(F.col("kinds") > OPEN_SEGMENTS), min_bytes, gram)
        )
        windows = materialise(windows, "repeated-windows")
    counted = F.col("earlier") if keep_first else F.lit(True)
    single = windows.where(counted).select(
        "doc_id", "t", (F.col("start") + F.col("a")).alias("begin"), (F.col("start") + F.col("b") + min_bytes).alias("end")
    )
    whole = kinds.where("n > 1").select("anchor", "segment", F.col("first.doc_id").alias("d"), F.col("first.t").alias("u"), F.col("first.start").alias("s"))
    copies = found.join(whole, ["anchor", "segment"])
    if keep_first:
        copies = copies.where(~(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t") == F.col("u")) & (F.col("start") == F.col("s"))))
    copies = copies.select("doc_id", "t", F.col("start").alias("begin"), (F.col("start") + F.col("size")).alias("end"))
    return single.unionByName(copies)


def _bytes_of(open_: DataFrame, texts: DataFrame, min_bytes: int) -> DataFrame:
    """The open segments with their bytes, cut from the text of their first place."""
    wanted = open_.select("anchor", "segment", "kinds", "n", "first.*")
    listed = wanted.groupBy("doc_id", "t").agg(F.collect_list(F.struct("anchor", "segment", "kinds", "n", "start", "size")).alias("parts"))
    named = listed.select(F.coalesce("doc_id", F.lit(0)).alias("_d"), F.col("doc_id").isNull().alias("_n"), F.col("t").alias("_t"), "parts")
    mark = F.xxhash64("doc_id", "t")
    met = texts.where(maybe_in(wanted, mark, mark)).join(
        named,
        (F.coalesce(texts["doc_id"], F.lit(0)) == named["_d"])
        & (texts["doc_id"].isNull() == named["_n"])
        & (texts["t"] == named["_t"]),
    )
    raw = F.encode("text", "UTF-8")
    part = F.explode("parts").alias("p")
    rows = met.select("doc_id", "t", raw.alias("raw"), part)
    return rows.select("doc_id", "t", "p.*", F.substring("raw", F.col("p.start").cast("int") + 1, F.col("p.size").cast("int")).alias("data"))


OUT = "doc_id long, none boolean, t long, start long, a int, b int, earlier boolean"


def _compare(parts: DataFrame, min_bytes: int, open_: DataFrame) -> DataFrame:
    """Repeating windows of open segments, by suffix order in buckets of anchors: runs from
    window ``a`` to ``b`` of the segment at ``start``."""
    buckets = max(1, open_.count() // BUCKET_SEGMENTS)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["none", "doc_id", "t", "start"], ascending=[False, True, True, True], kind="stable")
        group = group.drop_duplicates(["anchor", "segment"])
        part, place, earlier = repeated_windows(group["data"].tolist(), min_bytes)
        order = np.lexsort((place, part))
        part, place, earlier = part[order], place[order], earlier[order]
        rows = []
        for kind in (False, True):
            here = earlier == kind
            p, q = part[here], place[here]
            if not len(p):
                continue
            cut = np.flatnonzero((np.diff(p) != 0) | (np.diff(q) != 1))
            first, last = np.append(0, cut + 1), np.append(cut, len(p) - 1)
            rows.append(pd.DataFrame({"k": p[first], "a": q[first], "b": q[last], "earlier": kind}))
        if not rows:
            return pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")})
        out = pd.concat(rows, ignore_index=True)
        for c in ("doc_id", "none", "t", "start"):
            out[c] = group[c].array[out["k"].to_numpy()]
        return out[[c.split()[0] for c in OUT.split(", ")]]

    keyed = flagged(parts).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    keyed = keyed.select("bucket", "doc_id", "none", "t", "start", "anchor", "segment", "data")
    out = keyed.groupBy("bucket").applyInPandas(compare, OUT)
    return out.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")


def _runs(data: bytes, anchor: int, min_bytes: int, gram: int, stride: int) -> dict[str, np.ndarray]:
    """Runs of up to ``stride`` neighbouring windows of a segment. Places are counted from the
    anchor, so equal windows are in runs of one number ``k`` and at one place in them. ``at``,
    ``end``: the first window of the run and the one after its last; ``core``: hash of the
    bytes that all windows such a run can have hold; ``hull``, ``hull2``: hashes of all its
    bytes; ``full``: whether the segment has all windows of the run."""
    raw = np.frombuffer(data, "uint8")
    one, two = Rolling(raw), Rolling(raw[::-1].copy())
    n, place = len(raw) - min_bytes + 1, np.arange(len(raw) - gram + 1)
    found = int((one.of(place, place + gram).view("int64") == anchor).argmax())
    k = np.arange((found - n + 1) // stride, found // stride + 1)
    last = found - k * stride
    first = last - stride + 1
    at, end = np.maximum(first, 0), np.minimum(last + 1, n)
    stop = end - 1 + min_bytes
    return {
        "k": k, "at": at, "end": end, "full": (first >= 0) & (last < n), "core": one.of(last, first + min_bytes).view("int64"),
        "hull": one.of(at, stop).view("int64"), "hull2": two.of(len(raw) - stop, len(raw) - at).view("int64"),
    }


def _count_windows(parts: DataFrame, min_bytes: int, gram: int) -> DataFrame:
    """The same for anchors with very many segments, counted by Spark. Segments come as runs
    of neighbouring windows. No window of a run repeats unless the bytes that all of them hold
    do; and if all bytes of a run repeat, every window of it does, and one of the equal runs
    stands for them. What is left are the runs in which segments begin to differ, and one of
    each group of equal ones: their windows are narrow rows, told apart by two hashes of 64
    bits each."""
    # The rows are few and small, but each becomes many: they are dealt to all tasks.
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["doc_id", "t", "start"]
    stride = max(1, min(STRIDE, min_bytes // 2))
    rows = parts.select("anchor", *keys, "data").repartition(tasks, *keys).dropDuplicates(keys)
    rows = materialise(rows, "hot-segments")

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [_runs(data, anchor, min_bytes, gram, stride) for data, anchor in zip(batch["data"], batch["anchor"])]
            if held:
                whose = np.repeat(np.arange(len(batch)), [len(r["k"]) for r in held])
                same = {c: batch[c].to_numpy()[whose] for c in ("doc_id", "none", "t", "start", "anchor")}
                yield pd.DataFrame(same | {c: np.concatenate([r[c] for r in held]) for c in held[0]})

    kinds = "doc_id long, none boolean, t long, start long, anchor long, k long, at long, end long, full boolean, core long, hull long, hull2 long"
    made = flagged(rows).mapInPandas(runs, kinds).withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")
    made = materialise(made, "hot-runs")
    place = F.struct("doc_id", "t", F.col("start") + F.col("at"))
    several = made.groupBy("anchor", "k", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    equal = made.where("full").groupBy("anchor", "k", "hull", "hull2", "full")
    equal = equal.agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1").drop("n")
    open_ = made.join(several, ["anchor", "k", "core"]).join(equal, ["anchor", "k", "hull", "hull2", "full"], "left")
    open_ = materialise(open_.withColumn("stands", F.col("least").isNull() | place.eqNullSafe(F.col("least"))), "open-runs")
    whole = open_.where("least IS NOT NULL").select(
        *keys, F.col("at").cast("int").alias("a"), (F.col("end") - 1).cast("int").alias("b"), (~F.col("stands")).alias("earlier")
    )
    listed = open_.where("stands").groupBy(*keys).agg(F.collect_list(F.struct("at", "end")).alias("runs"))
    listed = join_null_safe(rows.select(*keys, "data"), listed, keys).repartition(tasks, *keys)

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def table(held: list[tuple]) -> pd.DataFrame:
            length = [len(at) for *_, at, _, _ in held]
            out = {name: np.repeat([r[i] for r in held], length) for i, name in enumerate(("doc_id", "none", "t", "start"))}
            return pd.DataFrame(out | {name: np.concatenate([r[i] for r in held]) for i, name in ((4, "at"), (5, "h"), (6, "g"))})

        for batch in batches:
            held, n = [], 0
            for row in batch.itertuples(index=False):
                data = np.frombuffer(row.data, "uint8")
                at = np.concatenate([np.arange(r["at"], r["end"]) for r in row.runs])
                one, two = Rolling(data), Rolling(data[::-1].copy())
                back = len(data) - at
                h, g = one.of(at, at + min_bytes).view("int64"), two.of(back - min_bytes, back).view("int64")
                held.append((row.doc_id, row.none, row.t, row.start, at.astype("int32"), h, g))
                n += len(at)
                if n > HELD_WINDOWS:
                    yield table(held)
                    held, n = [], 0
            if held:
                yield table(held)

    single = flagged(listed).mapInPandas(hashes, "doc_id long, none boolean, t long, start long, at int, h long, g long")
    single = single.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")
    single = materialise(single, "hot-windows")
    same = single.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1")
    hits = single.join(same, ["h", "g"])
    hits = hits.select(*keys, F.col("at").alias("a"), F.col("at").alias("b"), (place != F.col("least")).alias("earlier"))
    return whole.unionByName(hits)


def word_windows(data: np.ndarray, words: int, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """``start, end`` of the strings of ``words`` words that have under ``max_bytes`` bytes.
    Words stand between white space. The first may also begin and the last end at a sign
    inside its word, so that marks around a passage do not hide it."""
    none = np.zeros(0, "int64")
    inside = np.concatenate([[False], ~BLANK[data], [False]])
    begin, end = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if len(begin) < words:
        return none, none
    first = np.flatnonzero(begin[words - 1 :] - end[: len(end) - words + 1] < max_bytes)
    if not len(first):
        return none, none
    letter = np.concatenate([[False], LETTER[data], [False]])
    rises = np.append(-1, np.flatnonzero(letter[1:-1] & ~letter[:-2]))
    falls = np.append(np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1, len(data) + 1)
    last = first + words - 1
    rise = rises[np.searchsorted(rises, end[first]) - 1]
    fall = falls[np.searchsorted(falls, begin[last], "right")]
    starts = begin[first], np.maximum(begin[first], rise)
    ends = end[last], np.minimum(end[last], fall)
    pairs = np.unique(np.concatenate([s << 32 | e for s in starts for e in ends]))
    start, end = pairs >> 32, pairs & ((1 << 32) - 1)
    short = end - start < max_bytes
    return start[short], end[short]


def _stretches(texts: list[str], least: int, around: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes, list[int]]]:
    """Chunks of texts, a blank between them, without those under ``least`` bytes. A text
    longer than a chunk comes in parts, each with ``around`` bytes of its neighbours. Each
    part: number of its text, place in the text, place where what it adds begins."""
    owners, parts, size = [], [], 0
    for number, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        for begin in range(0, len(raw) if len(raw) >= least else 0, CHUNK_BYTES):
            low = max(0, begin - around)
            parts.append(raw[low : begin + CHUNK_BYTES + around] + b" ")
            owners.append((number, low, begin))
            size += len(parts[-1])
            if size >= CHUNK_BYTES:
                yield owners, b"".join(parts), [len(p) for p in parts]
                owners, parts, size = [], [], 0
    if parts:
        yield owners, b"".join(parts), [len(p) for p in parts]


def repeated_word_spans(
    docs: DataFrame, words: int, max_bytes: int, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, t, begin, end`` as ``repeated_spans``, of strings of ``words`` words with
    under ``max_bytes`` bytes; longer ones are found by their bytes."""
    least = 2 * words - 1

    def find(parts: Iterator[dict]) -> Iterator[dict]:
        for part in parts:
            ids, marks = part["doc_id"], part["t"]
            for owners, raw, sizes in _stretches(part["text"], least, max_bytes):
                data = np.frombuffer(raw, "uint8")
                start, end = word_windows(data, words, max_bytes)
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                piece = np.searchsorted(bounds, start, "right") - 1
                number, low, added = (np.array(c, "int64")[piece] for c in zip(*owners))
                begin = low + start - bounds[piece]
                own = (end < bounds[piece + 1]) & (begin >= added) & (begin < added + CHUNK_BYTES)
                if not own.any():
                    continue
                start, end, number = start[own], end[own], number[own].tolist()
                one, two = Rolling(data), Rolling(data[::-1].copy())
                yield {
                    "doc_id": [ids[n] for n in number], "t": [marks[n] for n in number], "begin": begin[own],
                    "size": end - start, "h": one.of(start, end).view("int64"),
                    "g": two.of(len(data) - end, len(data) - start).view("int64"),
                }

    texts = _stamped(docs, id_col, text_col).where(F.octet_length("text") >= least)
    rows = map_slices(texts, "doc_id long, t long, begin long, size long, h long, g long", find)
    with small_batches(docs.sparkSession):
        rows = materialise(rows, "word-windows")
    place = F.struct("doc_id", "t", "begin")
    equal = rows.groupBy("h", "g", "size").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).where("n > 1")
    hits = rows.join(equal, ["h", "g", "size"])
    if keep_first:
        hits = hits.where(place != F.col("least"))
    return hits.select("doc_id", "t", "begin", (F.col("begin") + F.col("size")).alias("end"))


def merged_spans(spans: DataFrame) -> DataFrame:
    """``doc_id, t, spans``: the maximal runs of each text, in order, without overlap."""

    @F.pandas_udf("array<struct<begin:long,end:long>>")
    def merge(lists: pd.Series) -> pd.Series:
        return pd.Series([_union(spans) for spans in lists])

    found = spans.groupBy("doc_id", "t").agg(F.collect_set(F.struct("begin", "end")).alias("all"))
    return found.select("doc_id", "t", merge("all").alias("spans"))


def _union(spans) -> list[dict]:
    out: list[list[int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [{"begin": a, "end": b} for a, b in out]


def cut(text: Column, spans: Column) -> Column:
    """The UTF-8 bytes of a text without the given spans; all of them without spans."""

    @F.pandas_udf("binary")
    def kept(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, lists):
            raw = text.encode("utf-8", "replace")
            if spans is not None:
                ends = [0, *(s["end"] for s in spans)]
                raw = b"".join(raw[a:b] for a, b in zip(ends, [*(s["begin"] for s in spans), len(raw)]))
            out.append(raw)
        return pd.Series(out, dtype=object)

    return kept(text, spans)


def whole_characters(raw: Column) -> Column:
    """The text of UTF-8 bytes; what is left of a character that was cut goes."""

    @F.pandas_udf("string")
    def text(parts: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else p.decode("utf-8", "ignore") for p in parts], dtype=object)

    return text(raw)


def remove_repeats(
    docs: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text",
    words: int | None = None,
) -> DataFrame:
    """``docs`` with the columns ``_n_bytes``, ``_spans`` (null without any) and ``_kept``
    (the bytes that stay; cut within a character where the match ends there). With
    ``words``, strings of that many words count as well as those of ``min_bytes`` bytes."""
    found = repeated_spans(docs, min_bytes, keep_first, id_col, text_col)
    if words:
        found = found.unionByName(repeated_word_spans(docs, words, min_bytes, keep_first, id_col, text_col))
    spans = merged_spans(found)
    spans = spans.select(F.coalesce("doc_id", F.lit(0)).alias("_d"), F.col("doc_id").isNull().alias("_n"), F.col("t").alias("_t"), F.col("spans").alias("_spans"))
    spans = materialise(spans, "spans")
    text, id_ = text_or_empty(text_col), F.col(id_col)
    mark = F.xxhash64(id_, F.xxhash64(text))
    marked = docs.withColumn("_maybe", maybe_in(spans, F.xxhash64(F.when(~F.col("_n"), F.col("_d")), "_t"), mark))
    met = marked.where("_maybe").join(
        spans,
        (F.coalesce(id_, F.lit(0)) == spans["_d"]) & (id_.isNull() == spans["_n"]) & (F.xxhash64(text) == spans["_t"]),
        "left",
    ).drop("_d", "_n", "_t", "_maybe")
    met = met.withColumn("_kept", cut(text, F.col("_spans")))
    none = F.lit(None).cast(spans.schema["_spans"].dataType)
    free = marked.where("NOT _maybe").drop("_maybe").withColumn("_spans", none).withColumn("_kept", F.encode(text, "UTF-8"))
    return met.unionByName(free).withColumn("_n_bytes", F.octet_length(text).cast("long"))
