"""Vector codes: product quantisation with equal-average search.

Vectors of integers are cut into equal parts; every part position has a codebook, and a
part is coded by the number of its nearest entry. The entries begin as parts of the first
vectors and move to the floored mean of what was assigned to them, for a few rounds.

The nearest entry is found by component sums. For parts of d components the squared
distance is at least (difference of the sums)^2 / d. Entries are sorted by their sum; a
part begins beside its own sum, goes outwards on the side whose sum is nearer, and stops
when the squared gap over d strictly exceeds the best distance: entries at that very
distance are still looked at, so ties go to the smaller number. A task does this for all
rows of a batch together, one entry a step, with the rows that have stopped left out.

Each round is one pass that sends a row for each part, entry and task; the codebooks
(parts x entries vectors of one part) are the only thing the driver holds, and their size
does not grow with the table. All arithmetic is in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import discard, materialise

#: Rows coded together.
BLOCK_ROWS = 4_096
EXACT = 1 << 62


def whole_rows(table: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``vec_id, label, v`` with components floor(scale * x); vectors that are null or hold a
    null or non-finite component are left out."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.where(F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest_by_sum(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest row of ``book`` to each row of ``x``, the smaller one of equals,
    and the squared distance."""
    width = book.shape[1]
    reach = max(int(np.abs(a).max(initial=0)) for a in (x, book)) * 2
    if max(1, width) ** 2 * reach * reach >= EXACT:
        x, book = x.astype(object), book.astype(object)  # Python integers: no bound
    sums, own = book.sum(1), x.sum(1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    right = np.searchsorted(sums, own)
    left = right - 1
    best = np.full(len(x), -1, x.dtype)
    found = np.zeros(len(x), "int64")
    active = np.arange(len(x))
    while len(active):
        lo, hi = left[active], right[active]
        below, above = lo >= 0, hi < len(sums)
        gap_lo = own[active] - sums[np.maximum(lo, 0)]
        gap_hi = sums[np.minimum(hi, len(sums) - 1)] - own[active]
        down = below & (~above | (gap_lo <= gap_hi))
        gap = np.where(down, gap_lo, gap_hi)
        on = (below | above) & ((best[active] < 0) | (gap * gap <= best[active] * width))
        active, down = active[on], down[on]
        entry = order[np.where(down, left[active], right[active])]
        apart = x[active] - book[entry]
        distance = (apart * apart).sum(1)
        known = best[active]
        better = (known < 0) | (distance < known) | ((distance == known) & (entry < found[active]))
        best[active[better]], found[active[better]] = distance[better], entry[better]
        left[active[down]] -= 1
        right[active[~down]] += 1
    return found, best


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray):
    """Blocks of rows with their parts, entry numbers and distances, a column for each part."""
    parts, _, width = books.shape
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(i, BLOCK_ROWS)
            x = _matrix(block.column("v")).reshape(len(block), parts, width)
            near = [nearest_by_sum(x[:, p], books[p]) for p in range(parts)]
            yield block, x, [f for f, _ in near], [d for _, d in near]


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: entries that were used become floored means."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(books.shape, object), np.zeros((parts, entries), "int64")
        for _, x, found, _ in _assigned(batches, books):
            for p in range(parts):
                order = np.argsort(found[p], kind="stable")
                used, first = np.unique(found[p][order], return_index=True)
                total[p, used] += np.add.reduceat(x[order, p], first, axis=0).astype(object)
                count[p] += np.bincount(found[p], minlength=entries)
        p, k, place = (a.ravel() for a in np.indices(books.shape))
        keep = count[p, k] > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p[keep], pa.int32()),
                pa.array(k[keep], pa.int32()),
                pa.array(place[keep], pa.int32()),
                pa.array(list(map(str, total[p, k, place][keep])), pa.string()),
                pa.array(count[p, k][keep], pa.int64()),
            ],
            ["p", "k", "place", "total", "n"],
        )

    total = F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    found = rows.mapInArrow(sums, "p int, k int, place int, total string, n long")
    moved = books.copy()
    for p, k, place, total, n in found.groupBy("p", "k", "place").agg(total, F.sum("n").alias("n")).collect():
        moved[p, k, place] = int(total) // n
    return moved


def _coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    digits = np.array([f"{k:02x}" for k in range(256)])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, found, distance in _assigned(batches, books):
            codes = ["".join(c) for c in zip(*[digits[f].tolist() for f in found])]
            errors = [sum(map(int, e)) for e in zip(*[d.tolist() for d in distance])]
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("label"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = rows.schema
    label = kinds["label"].dataType.simpleString()
    return rows.mapInArrow(code, f"vec_id long, label {label}, code string, error long")


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list]:
    """Codes of all whole vectors, and the codebooks (parts x entries x components).

    The DataFrame has ``vec_id, label, code`` (two hex digits for each part), ``error``
    (squared distances to the entries, summed over the parts) and ``label_error``
    (``error`` summed over rows of the same label; rows without a label are one group).

    Codebooks begin as the parts of the vectors with the smallest ids, ties by the vector,
    rows without an id last; with fewer vectors than ``entries`` there are fewer entries.
    Repeated rows and ids are coded like all others. An empty table, or one without whole
    vectors, gives no rows and no codebooks. Vectors whose length is not that of the
    smallest id's cannot be cut in the same way and are left out; a length that ``parts``
    does not divide, and a component or error beyond 64 bits, stop the job. Other columns
    are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry number has two hex digits: 1 to 256 entries")
    rows = materialise(whole_rows(vectors, id_col, vector_col, label_col, scale), "vectors")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    size = len(first[0]["v"]) if first else 0
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    begun = [r["v"] for r in first if len(r["v"]) == size]
    books = np.array(begun, "int64").reshape(len(begun), parts, -1 if size else 0).transpose(1, 0, 2)
    fit = rows.where(F.size("v") == size)
    if first:
        for _ in range(rounds):
            books = _moved(fit, books)
        coded = materialise(_coded(fit, books), "vector-codes")
    else:
        coded = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    if first:
        totals = materialise(totals, "label-errors")
        discard(rows)
    joined = coded.join(totals, coded["label"].eqNullSafe(totals["_label"])).drop("_label")
    return joined, books.tolist() if first else []


def books_digest(books: list) -> str:
    """SHA-256 of the components of all entries in order, joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
