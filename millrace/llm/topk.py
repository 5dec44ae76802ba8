"""Exact top-k search by inner product over a pivot-distance index.

Inner products become distances by one more coordinate: with M the largest norm, a
candidate x gets sqrt(M^2 - |x|^2) and a query 0, so that the squared distance is
|q|^2 + M^2 - 2 q.x. Every candidate is keyed by its nearest pivot and its distance to
it. The index is sorted by that key and cut into blocks of at most ``BLOCK_ROWS`` rows,
so a block is a ring around a pivot. By the triangle inequality no member of a ring
[lo, hi] is nearer to a query than its distance d to the pivot allows: lo - d or d - hi.

Search is in rounds. A query block first meets the rings with the smallest bounds, which
gives each query a k-th best score; after that only rings whose bound allows a score as
high are opened. The last round opens all of those, so the result is exact; rings that
no bound excludes are read in any case. Scores are integers and are computed exactly.

Pivots are fitted on a bounded sample (``SAMPLE_ROWS`` vectors). Queries and candidates
meet in blocks: a pair of blocks is one row of packed numbers, and each gives at most k
rows for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import materialise

PIVOTS = 32
#: Bound on the vectors the pivots are fitted on.
SAMPLE_ROWS = 4_096
BLOCK_ROWS = 1_024
QUERY_ROWS = 256
#: Rings a query block meets in each round before the last.
FIRST_RINGS = (2, 8)
#: Relative slack of bounds against rounding.
SLACK = 1e-9
EXACT = float(1 << 53)


def whole_vectors(table: DataFrame, vector: str, scale: int, id_col: str = "vec_id") -> DataFrame:
    """``vec_id, v`` with components floor(scale * x). Rows without an id, null vectors
    and those with a null or non-finite component are left out."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fit = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite
    return table.where(fit).select(
        F.col(id_col).alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"), F.col("_asks").alias("asks")
    )


def _matrix(vectors) -> np.ndarray:
    return np.array(list(vectors), "float64")


def _exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles while they are exact, else in integers."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if bound < EXACT:
        return (q.astype("float64") @ x.T.astype("float64")).astype("int64")
    out = q.astype(object) @ x.T.astype(object)
    if any(abs(s) >= 1 << 63 for s in out.flat):
        raise OverflowError("an inner product does not fit 64 bits")
    return out.astype("int64")


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Centres of a few rounds of clustering, begun at vectors far from one another."""
    chosen = [sample[0]]
    gap = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and gap.max() > 0:
        chosen.append(sample[int(gap.argmax())])
        gap = np.minimum(gap, ((sample - chosen[-1]) ** 2).sum(1))
    pivots = np.array(chosen)
    for _ in range(8):
        near = _distances(sample, pivots).argmin(1)
        pivots = np.array([sample[near == j].mean(0) if (near == j).any() else p for j, p in enumerate(pivots)])
    return pivots


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


def _packed(v: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them."""
    most = np.abs(v).max(initial=0)
    return v.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // max(1, rows * width)}").reshape(rows, width).astype("int64")


def _asking(q: np.ndarray) -> np.ndarray:
    """Queries with the further coordinate, which is 0 for them."""
    return np.hstack([q.astype("float64"), np.zeros((len(q), 1))])


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(0, top - (v * v).sum(1)))[:, None]])


def build_index(vectors: DataFrame, pivots: np.ndarray, top: float) -> DataFrame:
    """Blocks ``ring, pivot, lo, hi, n, ids, data`` of the vectors, sorted by (nearest
    pivot, distance). Rows are spread by sampled ranges of that key and the id, so a
    pivot with many rows, or many equal vectors, is spread over several tasks."""

    @F.pandas_udf("pivot int, distance double")
    def key(v: pd.Series) -> pd.DataFrame:
        out = _distances(_lifted(_matrix(v), top), pivots)
        near = out.argmin(1)
        return pd.DataFrame({"pivot": near.astype("int32"), "distance": out[np.arange(len(out)), near]})

    keyed = vectors.withColumn("k", key("v")).select("vec_id", "v", "k.pivot", "k.distance")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while held is not None and len(held):
                same = int((held["pivot"].to_numpy() != held["pivot"].iloc[0]).argmax()) or len(held)
                if same < BLOCK_ROWS and same == len(held):
                    break  # the block may go on in the next batch
                yield _block(held.iloc[: min(same, BLOCK_ROWS)])
                held = held.iloc[min(same, BLOCK_ROWS) :].reset_index(drop=True)
        if held is not None and len(held):
            yield _block(held)

    schema = "pivot int, lo double, hi double, n int, ids array<long>, data binary"
    sorted_ = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
    return sorted_.mapInPandas(blocks, schema).withColumn("ring", F.monotonically_increasing_id())


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "pivot": [rows["pivot"].iloc[0]],
            "lo": [rows["distance"].iloc[0]],
            "hi": [rows["distance"].iloc[-1]],
            "n": [len(rows)],
            "ids": [rows["vec_id"].tolist()],
            "data": [_packed(np.array(rows["v"].tolist(), "int64"))],
        }
    )


def query_blocks(queries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Blocks ``qb, qids, qdata, near, far, longest`` of similar queries: for each pivot the smallest
    and largest distance of the block's queries to it."""

    @F.pandas_udf("pivot int, distance double")
    def key(v: pd.Series) -> pd.DataFrame:
        out = _distances(_asking(_matrix(v)), pivots)
        near = out.argmin(1)
        return pd.DataFrame({"pivot": near.astype("int32"), "distance": out[np.arange(len(out)), near]})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), QUERY_ROWS):
                part = batch.iloc[i : i + QUERY_ROWS]
                q = np.array(part["v"].tolist(), "int64")
                d = _distances(_asking(q), pivots)
                yield pd.DataFrame(
                    {
                        "qids": [part["vec_id"].tolist()],
                        "qdata": [_packed(q)],
                        "near": [d.min(0).tolist()],
                        "far": [d.max(0).tolist()],
                        "longest": [float(np.sqrt((q.astype("float64") ** 2).sum(1).max()))],
                    }
                )

    schema = "qids array<long>, qdata binary, near array<double>, far array<double>, longest double"
    keyed = queries.withColumn("k", key("v")).select("vec_id", "v", "k.pivot", "k.distance")
    sorted_ = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
    return sorted_.mapInPandas(blocks, schema).withColumn("qb", F.monotonically_increasing_id())


def meet(pairs: DataFrame, k: int, top: float, pivots: np.ndarray) -> DataFrame:
    """``query_id, vec_id, score`` of the k best members of each ring for each query of the
    block it meets, as far as they reach the query's k-th best score so far. A row of
    ``pairs`` has a ring, a query block and ``floors`` (that score for each query)."""

    width = pivots.shape[1] - 1

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                qids, floors, ids = (np.asarray(c, "int64") for c in (row.qids, row.floors, row.ids))
                q, x = _unpacked(row.qdata, len(qids), width), _unpacked(row.data, len(ids), width)
                d = _distances(_asking(q), pivots[row.pivot : row.pivot + 1])[:, 0]
                bound = _best_score((q.astype("float64") ** 2).sum(1), d, row.lo, row.hi, top)
                open_ = np.flatnonzero(bound >= floors)
                if not len(open_):
                    continue
                scores = _exact_products(q[open_], x)
                allowed = (qids[open_][:, None] != ids[None]) & (scores >= floors[open_][:, None])
                order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores, ~allowed), axis=1)[:, :k]
                rows = np.arange(len(open_))[:, None]
                good = allowed[rows, order]
                yield pd.DataFrame(
                    {
                        "query_id": np.broadcast_to(qids[open_][:, None], order.shape)[good],
                        "vec_id": ids[order][good],
                        "score": scores[rows, order][good],
                    }
                )

    return pairs.mapInPandas(search, "query_id long, vec_id long, score long")


def _best_score(q2, d, lo, hi, top):
    """The highest score a member of the ring can have: a little more, for rounding."""
    gap = np.maximum(0.0, np.maximum(lo - d, d - hi))
    size = q2 + top
    return (size - gap * gap) / 2 + SLACK * size + 1


def best(found: DataFrame, k: int) -> DataFrame:
    rank = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(
    table: DataFrame, is_query: Column, k: int, vector: str = "embedding", scale: int = 256, id_col: str = "vec_id",
    pivots: int = PIVOTS, sample_rows: int = SAMPLE_ROWS, first_rings: tuple[int, ...] = FIRST_RINGS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``table`` that ``is_query`` the
    ``k`` other rows with the highest inner product, ties to the smaller id; fewer if there
    are fewer.

    Vectors count as whole numbers floor(scale * x). Null vectors, those with a null or
    non-finite component and rows without an id take no part. Vectors of different lengths
    do not meet. Every vector of an id takes part: rows with the query's own id are no
    candidates of it, the ``k`` places of an id with several vectors that ask are shared by
    them, and an id may be named more than once. Only a row that repeats both the id and
    the vector of another counts once with it. An empty table gives an empty result; other columns are not
    read. Scores beyond 64 bits raise an error.
    """
    asks = table.withColumn("_asks", F.coalesce(is_query, F.lit(False)))
    single = whole_vectors(asks, vector, scale, id_col).groupBy("vec_id", "v").agg(F.max("asks").alias("asks"))
    vectors = materialise(single, "topk-vectors")
    found = None
    for width in sorted(r["w"] for r in vectors.select(F.size("v").alias("w")).distinct().collect()):
        here = _search(vectors.where(F.size("v") == width), k, pivots, sample_rows, first_rings)
        found = here if found is None else found.unionByName(here)
    if found is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return best(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _search(vectors: DataFrame, k: int, n_pivots: int, sample_rows: int, first_rings: tuple[int, ...]) -> DataFrame:
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c)
    top = float(vectors.agg(F.max(norm)).first()[0])
    sample = vectors.select("v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toPandas()["v"]
    pivots = choose_pivots(_lifted(_matrix(sample), top), n_pivots)
    rings = materialise(build_index(vectors, pivots, top), "topk-index")
    asked = materialise(query_blocks(vectors.where("asks"), pivots), "topk-queries")
    # The gap between a block's queries and a ring, from their distances to its pivot.
    sides = asked.select("qb", "longest", F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "side"))
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("side.far"), F.col("side.near") - F.col("hi"))
    met = sides.join(rings.select("ring", "pivot", "lo", "hi"), "pivot").select("qb", "ring", "longest", gap.alias("gap"))
    met = materialise(
        met.withColumn("place", F.expr("row_number() OVER (PARTITION BY qb ORDER BY gap, ring)")), "topk-pairs"
    )
    size = F.col("longest") * F.col("longest") + F.lit(top)
    reach = (size - F.col("gap") * F.col("gap")) / 2 + F.lit(SLACK) * size + 1
    found, before = None, 0
    for last in (*first_rings, None):
        floors = _floors(asked, found, k)
        pairs = met.where(F.col("place") > before)
        pairs = pairs if last is None else pairs.where(F.col("place") <= last)
        open_ = pairs.join(floors, "qb").where(reach >= F.col("least")).select("qb", "ring", "floors")
        packed = open_.join(rings, "ring").join(asked.select("qb", "qids", "qdata"), "qb")
        columns = ["qids", "qdata", "floors", "pivot", "lo", "hi", "ids", "data"]
        now = meet(packed.select(columns), k, top, pivots)
        now = now if found is None else found.unionByName(now)
        found = materialise(best(now, k).drop("rank"), "topk-found")
        before = last
    return found


def _floors(asked: DataFrame, found: DataFrame | None, k: int) -> DataFrame:
    """``qb, floors, least``: for each query block its queries' k-th best scores so far, in
    the order of ``qids``, and the least of them. A query with fewer answers has the lowest
    number."""
    lowest = F.lit(int(np.iinfo("int64").min))
    if found is None:
        return asked.select("qb", F.transform("qids", lambda _: lowest).alias("floors"), lowest.alias("least"))
    kth = found.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    members = asked.select("qb", F.posexplode("qids").alias("at", "query_id")).join(kth, "query_id", "left")
    floor = F.struct("at", F.coalesce("kth", lowest).alias("floor"))
    blocks = members.groupBy("qb").agg(F.array_sort(F.collect_list(floor)).alias("f"))  # QUERY_ROWS at most
    return blocks.select("qb", F.col("f.floor").alias("floors"), F.array_min("f.floor").alias("least"))
