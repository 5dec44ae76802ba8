"""Shards of near-equal bytes by sampled splitters.

Records are laid out by (hash of the text, hash of the id), so equal texts lie side by
side. A size-weighted sample of the keys gives quantile boundaries; the ranges between
them are measured exactly, ranges that came out overfull are sampled again and
subdivided, and the measured ranges are dealt to the shards.

A text whose copies hold more than a hundredth of a shard has a range of its own (at
most 100 such texts for each shard, because their bytes add up). One that is larger
than a shard is subdivided by the hash of the id. So is one of more than a million rows,
however few bytes they have; if it fits a shard, its pieces are dealt to one together.
Everything the driver sees is a number of ranges: some for each shard, and one for each
million rows.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty
from millrace.sources.tables import materialise

RECORD_BYTES = 16
HEAVY_PARTS = 100
RANGES_PER_SHARD = 32
ROWS_PER_RANGE = 1_000_000
DRAWS_PER_RANGE = 8


def _unit(column: Column) -> Column:
    """A number from 0 up to 1 from a hash."""
    return F.shiftrightunsigned(column, 11) / F.lit(2.0**53)


@dataclass(frozen=True)
class Ranges:
    """Units of placement: heavy texts (in pieces), then the ranges between splitters."""

    splitters: np.ndarray
    heavy: np.ndarray  # hashes, sorted
    pieces: np.ndarray  # of each heavy text
    together: np.ndarray  # whether its pieces share a shard

    def unit(self, key: Column, sub: Column) -> Column:
        splitters, heavy, pieces = self.splitters, self.heavy, self.pieces
        first = np.concatenate([[0], np.cumsum(pieces)]).astype("int64")

        @F.pandas_udf("long")
        def number(key: pd.Series, sub: pd.Series) -> pd.Series:
            k = key.to_numpy("int64")
            out = np.searchsorted(splitters, k, "right").astype("int64") + first[-1]
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, k), len(heavy) - 1)
                own = heavy[at] == k
                piece = np.minimum((sub.to_numpy("float64") * pieces[at]).astype("int64"), pieces[at] - 1)
                out = np.where(own, first[at] + piece, out)
            return pd.Series(out)

        return number(key, sub)

    def deal(self, units: list[tuple[int, int]], shards: int) -> dict[int, int]:
        """Shard of each unit, given as (unit, bytes); a text that fits one shard is one unit."""
        first = np.concatenate([[0], np.cumsum(self.pieces)]).astype("int64")
        leads, sums = {}, {}
        for unit, size in units:
            text = int(np.searchsorted(first, unit, "right")) - 1
            whole = text < len(self.pieces) and self.together[text]
            leads[unit] = int(first[text]) if whole else unit
            sums[leads[unit]] = sums.get(leads[unit], 0) + size
        shard_of = deal(list(sums.items()), int(first[-1]), shards)
        return {unit: shard_of[lead] for unit, lead in leads.items()}


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        _unit(F.xxhash64(F.col(id_col), F.lit(1))).alias("sub"),
    )


def fit_ranges(rows: DataFrame, shards: int) -> Ranges:
    """Ranges for ``rows`` (of ``keyed``); reads them once for the heavy texts and once
    for each round of sampling (a second round only if a range came out overfull)."""
    texts = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    whole = texts.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    total, n = int(whole["bytes"] or 0), int(whole["n"] or 0)
    share = total / shards
    limit = share / HEAVY_PARTS
    large = (F.col("bytes") > limit) | (F.col("n") > ROWS_PER_RANGE)
    heavy = sorted((r["key"], r["bytes"], r["n"]) for r in texts.where(large).collect())
    keys = np.array([k for k, _, _ in heavy], "int64")
    together = np.array([b <= share for _, b, _ in heavy], bool)
    by_rows = [math.ceil(n / ROWS_PER_RANGE) for _, _, n in heavy]
    pieces = np.array([p if b <= share else max(p, math.ceil(b / limit)) for p, (_, b, _) in zip(by_rows, heavy)], "int64")
    light_bytes = total - sum(b for _, b, _ in heavy)
    ranges = max(RANGES_PER_SHARD * shards, n // ROWS_PER_RANGE)
    splitters = np.array([], "int64")
    overfull: set[int] | None = None
    draws = ranges * DRAWS_PER_RANGE
    while light_bytes and (overfull is None or overfull):
        here = Ranges(splitters, keys, pieces, together)
        unit = here.unit(F.col("key"), F.col("sub"))
        light = rows.withColumn("unit", unit).where(F.col("unit") >= int(pieces.sum()))
        if overfull is not None:
            light = light.where(F.col("unit").isin(sorted(overfull)))
        draw = _unit(F.xxhash64("doc_id", "key", F.lit(len(splitters) + 2)))
        sample = light.where(draw < F.col("size") * F.lit(draws / light_bytes)).select("key").toPandas()["key"]
        drawn = np.sort(sample.to_numpy("int64"))
        more = np.setdiff1d(drawn[DRAWS_PER_RANGE - 1 :: DRAWS_PER_RANGE], splitters)
        if not len(more):
            break
        splitters = np.union1d(splitters, more)
        measured = Ranges(splitters, keys, pieces, together).unit(F.col("key"), F.col("sub"))
        sizes = rows.groupBy(measured.alias("unit")).agg(F.sum("size").alias("b"), F.min("key") < F.max("key"))
        sizes = sizes.toDF("unit", "b", "divisible").where(F.col("unit") >= int(pieces.sum()))
        bound = 3 * light_bytes / ranges
        overfull = {r["unit"] for r in sizes.where(F.col("divisible") & (F.col("b") > bound)).collect()}
    return Ranges(splitters, keys, pieces, together)


def deal(units: list[tuple[int, int]], first_light: int, shards: int) -> dict[int, int]:
    """Shard of each unit, given as (unit, bytes): large pieces go to the least loaded
    shard, then neighbouring ranges together fill each shard up, then the small pieces
    level out what is left."""
    share = sum(b for _, b in units) / shards
    by_size = sorted((u for u in units if u[0] < first_light), key=lambda u: (-u[1], u[0]))
    large = [u for u in by_size if u[1] > share / 20]
    load = [(0.0, s) for s in range(shards)]
    out = {}

    def spread(pieces):
        heapq.heapify(load)
        for unit, size in pieces:
            filled, shard = heapq.heappop(load)
            out[unit] = shard
            heapq.heappush(load, (filled + size, shard))

    spread(large)
    light = sorted(u for u in units if u[0] >= first_light)
    room = np.zeros(shards)
    for filled, shard in load:
        room[shard] = max(0.0, share - filled)
    bytes_ = np.array([b for _, b in light], "float64")
    if len(light):
        ends = np.cumsum(room) * (bytes_.sum() / max(room.sum(), 1e-9))
        middle = np.cumsum(bytes_) - bytes_ / 2
        filled = dict((s, f) for f, s in load)
        for (unit, size), shard in zip(light, np.minimum(np.searchsorted(ends, middle, "right"), shards - 1)):
            out[unit] = int(shard)
            filled[int(shard)] += size
        load = [(f, s) for s, f in filled.items()]
    spread(u for u in by_size if u[1] <= share / 20)
    return out


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, unit`` for each row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus ``RECORD_BYTES``; shards
    have near-equal sums of it. ``slot`` numbers the rows of a shard from 0 without
    gaps. Equal texts share a shard, unless their copies are larger than one. Rows
    without an id and repeated rows are placed like all others. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = materialise(keyed(docs, id_col, text_col), "shard-keys")
    fitted = fit_ranges(rows, shards)
    placed = materialise(rows.withColumn("unit", fitted.unit(F.col("key"), F.col("sub"))), "shard-units")
    sums = placed.groupBy("unit").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    shard_of = fitted.deal([(r["unit"], r["b"]) for r in sums], shards)
    filled = [0] * shards
    table = []
    for r in sorted(sums, key=lambda r: r["unit"]):
        shard = shard_of[r["unit"]]
        table.append((r["unit"], shard, filled[shard]))
        filled[shard] += r["n"]
    units = docs.sparkSession.createDataFrame(table, "unit long, shard int, before long")
    place = F.expr("row_number() OVER (PARTITION BY unit ORDER BY key, sub, doc_id, size)")
    numbered = placed.withColumn("place", place)
    return numbered.join(F.broadcast(units), "unit").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place") - 1).alias("slot"), "unit"
    )


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the records themselves, a folder for each shard. Each range is written by
    one task, so a shard is written by as many tasks as it has ranges."""
    rows = keyed(docs, id_col, text_col)
    fitted = fit_ranges(materialise(rows, "shard-keys"), shards)
    text = text_or_empty(text_col)
    unit = fitted.unit(F.xxhash64(text), _unit(F.xxhash64(F.col(id_col), F.lit(1))))
    named = docs.withColumn("_unit", unit)
    sums = rows.groupBy(fitted.unit(F.col("key"), F.col("sub")).alias("unit")).agg(F.sum("size").alias("b")).collect()
    shard_of = fitted.deal([(r["unit"], r["b"]) for r in sums], shards)
    cases = docs.sparkSession.createDataFrame(list(shard_of.items()), "_unit long, shard int")
    named.join(F.broadcast(cases), "_unit").repartition("_unit").drop("_unit").write.partitionBy("shard").parquet(path)
