"""Best-fit packing of documents into sequences of several permitted lengths.

Only the number of pieces of each length matters for packing, and there are at most as
many lengths as the longest sequence has tokens. So the driver packs that histogram:
equal bins are handled as one group with a count, and the plan is a list of intervals
"pieces number a to b of length l go to bins x, x+1, ..., at this offset". Its size
depends on the permitted lengths, not on the corpus. Spark numbers the pieces of each
length and looks every piece up in the plan.

Lengths are placed from the longest down, into the open bins with the least room that
is enough. Where none has room, the bin size with the least cost per token it is likely
to hold is opened (the likely contents are read off what is left of the histogram).
This is done once with that choice and once with each single size as the size to open;
the cheapest outcome after downsizing every bin to its contents is taken.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import materialise

SIZES = (512, 1024, 2048, 4096, 8192)
#: Pieces of one length are numbered in slices of about this many.
SLICE_ROWS = 16_384


def sequence_cost(size: int) -> float:
    """Tokens, a fixed charge for each sequence, and attention, which grows with the
    length of the sequence: in units of one token at length 0."""
    return 32 + size * (1 + size / 65_536)


@dataclass
class Plan:
    """Intervals, sorted by (length, first): ``first`` piece of the interval, its bin,
    the offset in the bin. ``bins``: (first bin, number of bins, contents)."""

    intervals: list[tuple[int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int]] = field(default_factory=list)
    cost: float = 0.0


class _Left:
    """Pieces left of each length, and all lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.present = sorted(counts)


def _fill(counts: _Left, length: int, size: int) -> int:
    """Tokens one bin of ``size`` would hold after ``length``: the longest lengths left
    that fit, one after the other."""
    used, below = length, length
    present = counts.present
    while used < size:
        below = min(below, size - used)
        at = bisect_left(present, below + 1) - 1
        while at >= 0 and not counts.left[present[at]]:
            at -= 1
        if at < 0:
            break
        take = min(int(counts.left[present[at]]), (size - used) // present[at])
        used += take * present[at]
        below = present[at] - 1
    return used


def pack_histogram(
    counts: dict[int, int], sizes: Sequence[int] = SIZES, cost: Callable[[int], float] = sequence_cost,
    opening: int | None = None,
) -> Plan:
    """The plan for ``counts`` pieces of each length. ``opening``: the one size to open
    where it is long enough; None for the size of least cost per token."""
    sizes = sorted(sizes)
    plan, bins = Plan(), 0
    room: list[int] = []  # residuals of open bins, sorted, without repeats
    groups: dict[int, list[tuple[int, int, int]]] = {}  # residual -> (first bin, bins, size)
    left = _Left({k: v for k, v in counts.items() if v})

    def keep(residual: int, group: tuple[int, int, int]) -> None:
        if residual not in groups:
            groups[residual] = []
            insort(room, residual)
        groups[residual].append(group)

    for length in reversed(left.present):
        n = left.left[length]
        first = 0
        left.left[length] = 0
        while n:
            at = bisect_left(room, length)
            if at < len(room):
                residual = room[at]
                bin_, k, size = groups[residual].pop()
                if not groups[residual]:
                    del groups[residual], room[at]
                # the bin that took a piece has the least room that is enough, until it is full
                layers = min(n, residual // length)
                take = min(k, n // layers)
                if take < k:
                    keep(residual, (bin_ + take, k - take, size))
                for layer in range(layers):
                    plan.intervals.append((length, first + layer * take, bin_, size - residual + layer * length))
                keep(residual - layers * length, (bin_, take, size))
                first, n = first + layers * take, n - layers * take
                continue
            fits = [s for s in sizes if s >= length]
            left.left[length] = n - 1
            if opening is None:
                size = min(fits, key=lambda s: (cost(s) / _fill(left, length, s), s))
            else:
                size = opening if opening in fits else fits[0]
            left.left[length] = 0
            layers = min(n, size // length)
            k = n // layers
            for layer in range(layers):
                plan.intervals.append((length, first + layer * k, bins, layer * length))
            keep(size - layers * length, (bins, k, size))
            bins, first, n = bins + k, first + layers * k, n - layers * k
    for residual, found in groups.items():
        for bin_, k, size in found:
            plan.bins.append((bin_, k, size - residual))
            plan.cost += k * cost(next(s for s in sizes if s >= size - residual))
    plan.intervals.sort()
    plan.bins.sort()
    return plan


def best_plan(counts: dict[int, int], sizes: Sequence[int] = SIZES, cost=sequence_cost) -> Plan:
    plans = [pack_histogram(counts, sizes, cost, opening) for opening in (None, *sizes)]
    return min(plans, key=lambda p: p.cost)


def word_count(text: str = "text") -> Column:
    """Words of the text and one token that ends the document."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1


def cut_long(docs: DataFrame, n_tokens: Column, longest: int, id_col: str = "doc_id") -> DataFrame:
    """Pieces (``doc_id, piece, start, length``): a document longer than the longest
    sequence is cut into full sequences and a rest; a document without tokens has none."""
    sized = docs.select(F.col(id_col).alias("doc_id"), n_tokens.cast("long").alias("n")).where("n > 0")
    last = F.floor((F.col("n") - 1) / longest)
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * longest
    return pieces.select("doc_id", "piece", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).alias("length"))


def pack(
    docs: DataFrame, n_tokens: Column | None = None, sizes: Sequence[int] = SIZES, cost=sequence_cost,
    id_col: str = "doc_id",
) -> DataFrame:
    """``doc_id, piece, start_token, n_tokens, bin_id, bin_offset, bin_size`` for each piece.

    Every token of every document is in one piece and every piece in one bin, next to
    the others without overlap; ``bin_size`` is the smallest permitted size that holds
    the bin's contents. ``n_tokens`` defaults to the words plus an end token, so that a
    null or empty text is a piece of one token. Rows without an id and repeated rows are
    pieces like all others. Other columns are not read.
    """
    sizes = sorted(sizes)
    n_tokens = word_count() if n_tokens is None else n_tokens
    items = materialise(cut_long(docs, n_tokens, sizes[-1], id_col), "pack-items")
    counts = {int(r["length"]): r["count"] for r in items.groupBy("length").count().collect()}
    plan = best_plan(counts, sizes, cost)
    slices = np.ones(sizes[-1] + 1, "int64")
    for length, n in counts.items():
        slices[length] = -(-n // SLICE_ROWS)

    @F.pandas_udf("long")
    def slice_of(length: pd.Series, draw: pd.Series) -> pd.Series:
        n = slices[length.to_numpy("int64")]
        return pd.Series((draw.to_numpy("int64").view("uint64") % n.astype("uint64")).astype("int64"))

    cut = items.withColumn("slice", slice_of("length", F.xxhash64("doc_id", "piece")))
    sliced = materialise(cut, "pack-slices") if slices.max() > 1 else cut
    numbered = sliced.withColumn(
        "place", F.expr("row_number() OVER (PARTITION BY length, slice ORDER BY doc_id, piece) - 1")
    )
    before = np.zeros(0, "int64")
    keys = np.zeros(0, "int64")
    if slices.max() > 1:
        known = sorted((r["length"], r["slice"], r["count"]) for r in sliced.groupBy("length", "slice").count().collect())
        keys = np.array([length << 40 | s for length, s, _ in known], "int64")
        sums = np.cumsum([0] + [n for *_, n in known])[:-1]
        starts = {length: sums[i] for i, (length, s, _) in reversed(list(enumerate(known)))}
        before = np.array([sums[i] - starts[length] for i, (length, *_) in enumerate(known)], "int64")
    intervals = np.array(plan.intervals, "int64").reshape(-1, 4)
    lows = intervals[:, 0] << 40 | intervals[:, 1]
    bins = np.array(plan.bins, "int64").reshape(-1, 3)
    permitted = np.array(sizes, "int64")

    @F.pandas_udf("bin_id long, bin_offset long, bin_size long")
    def look_up(length: pd.Series, slice_: pd.Series, place: pd.Series) -> pd.DataFrame:
        ell, rank = length.to_numpy("int64"), place.to_numpy("int64")
        if len(keys):
            rank = rank + before[np.searchsorted(keys, ell << 40 | slice_.to_numpy("int64"))]
        at = np.searchsorted(lows, ell << 40 | rank, "right") - 1
        bin_ = intervals[at, 2] + rank - intervals[at, 1]
        held = bins[np.searchsorted(bins[:, 0], bin_, "right") - 1, 2]
        size = permitted[np.searchsorted(permitted, held)]
        return pd.DataFrame({"bin_id": bin_, "bin_offset": intervals[at, 3], "bin_size": size})

    looked_up = numbered.withColumn("b", look_up("length", "slice", "place"))
    return looked_up.select(
        "doc_id", "piece", F.col("start").alias("start_token"), F.col("length").alias("n_tokens"),
        "b.bin_id", "b.bin_offset", "b.bin_size",
    )
