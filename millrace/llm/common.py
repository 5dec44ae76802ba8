"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.hashing import maybe_in
from millrace.sources.tables import materialise

#: White space between words, as the contracts state it.
BLANKS = r"[\x20\x09-\x0D]+"


#: Rows whose texts are Python objects at one time.
SLICE_ROWS = 256
#: Bytes of an Arrow batch in the jobs of ``small_batches``.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

KINDS = {
    "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside send Arrow batches of at most BATCH_BYTES to Python: beside the rows
    that sorts and joins hold, a task then has little memory outside the heap."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def map_slices(df: DataFrame, schema: str, work: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """``work`` maps the rows of a partition, as column lists of a few rows, to column lists
    of ``schema``. Arrow batches are never turned into Python objects as a whole."""
    fields = [f.split() for f in schema.split(", ")]
    into = pa.schema([(name, KINDS[kind]) for name, kind in fields])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(i, SLICE_ROWS).to_pydict() for b in batches for i in range(0, b.num_rows, SLICE_ROWS))
        for columns in work(parts):
            yield pa.RecordBatch.from_pydict(columns, schema=into)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(go, schema)


def text_or_empty(column: str | Column = "text") -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def stamp(text: str = "text") -> Column:
    """Hash of a text; with the id it names a row."""
    return F.xxhash64(text_or_empty(text))


def drop_rows(docs: DataFrame, gone: DataFrame, text: str = "text", thin: bool = True) -> DataFrame:
    """``docs`` without the rows whose id and text stamp are in ``gone`` (``doc_id, t``; the
    id may be null). With ``thin`` only rows that may be in it are shuffled, which a Python
    filter finds; without it all rows are. Columns stay as they are."""
    gone = materialise(
        gone.select(
            F.coalesce("doc_id", F.lit(0)).alias("_d"), F.col("doc_id").isNull().alias("_n"), F.col("t").alias("_t"),
            F.xxhash64("doc_id", "t").alias("_mark"),
        ).distinct(),
        "gone",
    )
    if not thin:
        return docs.join(gone, _same_row(gone, text), "left_anti")
    marked = docs.withColumn("_maybe", maybe_in(gone, F.col("_mark"), F.xxhash64("doc_id", stamp(text))))
    left = marked.where("_maybe").join(gone, _same_row(gone, text), "left_anti")
    return marked.where("NOT _maybe").unionByName(left).drop("_maybe")


def _same_row(gone: DataFrame, text: str) -> Column:
    return (
        (F.coalesce(F.col("doc_id"), F.lit(0)) == gone["_d"])
        & (F.col("doc_id").isNull() == gone["_n"])
        & (stamp(text) == gone["_t"])
    )
