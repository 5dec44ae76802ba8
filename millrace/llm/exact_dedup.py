"""Exact dedup by an extendible-hash index on shared files.

Every text is normalised, hashed to 64 bits and filed under that hash. The hash
index is a directory over the leading bits of the hash: a bucket that holds more
keys than ``capacity`` is split on its next bit, and the directory doubles when a
bucket is deeper than it. The directory is made first, from the hashes alone; every
row then finds its bucket in it, and so does every row that looks its group up.

The owner of a bucket and hash receives the rows filed there and compares their bytes:
it keeps one copy of each different text, the smallest id and the count. A key with one
text is settled with that. A key with several is a chain, and its rows are counted text
by text. Each bucket is a folder of the index, sorted by hash and place in the chain.

Copies are summed up before the shuffle, so a text with a third of all rows sends
one row from each task, and a key never is more than one row of a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import BLANKS, stamp, text_or_empty
from millrace.sources.tables import discard, materialise, work_path

#: The directory has at most 2 ** MAX_DEPTH cells, which bounds what is broadcast
#: (65,536 rows of two numbers). Buckets at this depth grow instead of splitting; the
#: owners' tasks do not, because they share the keys of a bucket.
MAX_DEPTH = 16
CAPACITY = 65_536


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def _hash(norm: Column, hash_bits: int) -> Column:
    """Leading ``hash_bits`` bits of the hash; fewer than 64 only to test chains."""
    full = F.xxhash64(norm)
    return full if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(full, 64 - hash_bits), 64 - hash_bits)


def grow_directory(counts: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> tuple[int, list[tuple[int, int]]]:
    """Split overfull buckets until none can be split: ``counts`` has the keys of
    each prefix of ``max_depth`` bits. Returns the directory's depth and its buckets
    as (prefix, depth of the bucket), in the order of their hash ranges."""
    depth, done, open_ = 1, [], [(0, 1, {}), (1, 1, {})]
    for cell, n in counts.items():
        open_[cell >> (max_depth - 1)][2][cell] = n
    while open_:
        prefix, local, cells = open_.pop()
        if local == max_depth or sum(cells.values()) <= capacity:
            done.append((prefix, local))
            continue
        depth = max(depth, local + 1)  # the directory doubles
        halves = ({}, {})
        for cell, n in cells.items():
            halves[cell >> (max_depth - local - 1) & 1][cell] = n
        open_ += [(prefix * 2 + bit, local + 1, halves[bit]) for bit in (0, 1)]
    return depth, sorted(done, key=lambda b: b[0] << (max_depth - b[1]))


class Directory:
    """The cells of the hash space and the buckets they point to."""

    def __init__(self, hashes: DataFrame, capacity: int = CAPACITY):
        """``hashes`` has a column ``hash``; repeated hashes are one key."""
        cells = hashes.distinct().groupBy(F.shiftrightunsigned("hash", 64 - MAX_DEPTH).alias("cell")).count()
        self.depth, buckets = grow_directory({r["cell"]: r["count"] for r in cells.toLocalIterator()}, capacity)
        self.cells = hashes.sparkSession.createDataFrame(
            [
                (cell, number)
                for number, (prefix, local) in enumerate(buckets)
                for cell in range(prefix << (self.depth - local), (prefix + 1) << (self.depth - local))
            ],
            "cell long, bucket long",
        )

    def file(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``hash``) and their ``bucket``. At most 2 ** MAX_DEPTH cells are
        broadcast."""
        cell = F.shiftrightunsigned("hash", 64 - self.depth)
        return rows.withColumn("cell", cell).join(F.broadcast(self.cells), "cell").drop("cell")


def _settle(filed: DataFrame) -> DataFrame:
    """``bucket, hash, sha, keep_id, group_size, chain`` for each different text of rows filed
    under ``bucket`` and ``hash``. Owners compare bytes: ``texts`` holds the different texts of
    a key, one unless hashes collide."""
    least, copies = F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    owned = filed.groupBy("bucket", "hash").agg(F.collect_set("norm").alias("texts"), least, copies)
    sha = F.sha2(F.col("texts")[0], 256)
    owned = materialise(
        owned.select("bucket", "hash", F.size("texts").alias("links"), sha.alias("sha"), "keep_id", "group_size"),
        "dedup-owned",
    )
    single = owned.where("links = 1").select("bucket", "hash", "sha", "keep_id", "group_size", F.lit(1).alias("chain"))
    collided = owned.where("links > 1").select("bucket", "hash")
    if collided.isEmpty():
        single.millrace_path = owned.millrace_path
        return single
    links = filed.join(collided, ["bucket", "hash"], "left_semi").groupBy("bucket", "hash", "norm").agg(least, copies)
    in_chain = Window.partitionBy("bucket", "hash").orderBy("keep_id", "sha")
    links = links.select("bucket", "hash", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    settled = single.unionByName(links.withColumn("chain", F.row_number().over(in_chain)))
    settled.millrace_path = owned.millrace_path
    return settled


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, hash_bits: int = 64
) -> tuple[DataFrame, Directory]:
    """The index and its directory. The index has one row for each different text, with
    ``hash``, ``sha`` (SHA-256 of the normalised text, lowercase hex), ``keep_id``,
    ``group_size``, ``bucket``, ``chain`` (place among the texts of its hash, from 1). Stored
    in the shared folder, a folder for each bucket."""
    spark = docs.sparkSession
    norm = normalised(text_col)
    entries = docs.select(F.col(id_col).alias("id"), norm.alias("norm"), _hash(norm, hash_bits).alias("hash"))
    directory = Directory(entries.select("hash"), capacity)
    settled = _settle(directory.file(entries))
    path = work_path(spark, "dedup-index")
    owned = settled.repartition(F.col("bucket")).sortWithinPartitions("bucket", "hash", "chain")
    owned.write.partitionBy("bucket").parquet(path)
    discard(settled)
    schema = "hash long, sha string, keep_id long, group_size long, chain int, bucket long"
    return spark.read.schema(schema).parquet(path), directory


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, hash_bits: int = 64
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id`` (smallest id of the
    equal texts), ``group_size``, ``kept``, ``text_sha256``, ``bucket``, ``chain``,
    ``t`` (stamp of the text as it is).

    Texts are equal when their bytes are, after each run of blanks became one space;
    a null text is the empty text. A row without an id belongs to its group and is
    never kept (``keep_id`` is null when no row of the group has an id). Repeated rows
    of one id stay repeated and carry the same flags. Very long texts are whole, like all
    others. Other columns are not read. An empty table gives an empty result.
    """
    index, directory = build_index(docs, id_col, text_col, capacity, hash_bits)
    norm = normalised(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        _hash(norm, hash_bits).alias("hash"),
        F.sha2(norm, 256).alias("sha"),
        stamp(text_col).alias("t"),
    )
    return directory.file(rows).join(index, ["bucket", "hash", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "bucket",
        "chain",
        "t",
    )
