"""Range-partitioned tables on parquet: routing, switching, splitting, merging."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.tables import exists, remove, rename_new, subfolders

BUCKET = "bucket"
#: The folder of a file of rows, as a partition column of the files.
PART = "part"


def partition_number(column: Column, boundaries: Sequence[Column]) -> Column:
    """1-based partition of a value; a boundary belongs to the partition on its right."""
    number = F.lit(1)
    for b in boundaries:
        number = number + F.when(column >= b, 1).otherwise(0)
    return number


def write_partitioned(df: DataFrame, path: str, column: Column, boundaries: Sequence[Column]) -> None:
    """Route rows to partitions and write. Rebalancing gathers each partition in
    few files and splits one that is too large for a task."""
    routed = df.withColumn(BUCKET, partition_number(column, boundaries))
    routed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def partition_stats(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high")
    )


class PartitionedTable:
    """A table cut into partitions at boundaries of one column.

    Rows are in folders with names of their own, and a short list says which folders make up
    which partition, from which boundary. Every change writes new folders first, where it
    needs any, and then the next list under the next number, by one rename that fails if
    the number is taken. A reader sees the list before or after a change, and a change that
    stops half way leaves the table as it was. Folders that no list names are removed by
    ``clean``.

    A boundary belongs to the partition on its right; rows without a value are in the first.
    Partitions are numbered from 1. The list is as long as there are partitions, and is all
    that is read on the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = spark.read.parquet(f"{self.path}/schema").schema
        newest = max(int(n) for n in subfolders(spark, f"{self.path}/lists"))
        self.version = newest
        rows = spark.read.parquet(f"{self.path}/lists/{newest}").collect()
        self.column = rows[0]["column"]
        parts = sorted((r for r in rows if r["archive"] is None), key=lambda r: r["place"])
        #: Lower boundary and folders of each partition, in order.
        self.parts = [(r["low"], list(r["folders"])) for r in parts]
        #: Folders of each partition that was switched out.
        self.archives = {r["archive"]: list(r["folders"]) for r in rows if r["archive"] is not None}

    @classmethod
    def create(cls, df: DataFrame, path: str, column: str, boundaries: Sequence[Column]) -> PartitionedTable:
        """Write ``df`` cut at ``boundaries``, which must rise."""
        spark, kind = df.sparkSession, df.schema[column].dataType
        lows = list(df.sparkSession.range(1).select(*[b.cast(kind).alias(f"b{n}") for n, b in enumerate(boundaries)]).first()) if boundaries else []
        if any(x is None for x in lows) or any(a >= b for a, b in zip(lows, lows[1:])):
            raise ValueError("boundaries must rise and not be null")
        if PART in df.columns or BUCKET in df.columns:
            raise ValueError(f"the columns {PART} and {BUCKET} are those of the partitions")
        number = partition_number(F.col(column), [F.lit(x).cast(kind) for x in lows])
        routed = df.withColumn(PART, F.concat(F.lit("p"), number.cast("string")))
        df.limit(0).write.parquet(f"{path}/schema")
        routed.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{path}/data")
        there = set(subfolders(spark, f"{path}/data"))
        table = cls.__new__(cls)
        table.spark, table.path, table.schema, table.version, table.column = spark, path.rstrip("/"), df.schema, 0, column
        parts = [(low, [f"p{n}"] if f"{PART}=p{n}" in there else []) for n, low in enumerate([None, *lows], start=1)]
        return table._published(parts, {})

    def read(self) -> DataFrame:
        """All rows with the number of their partition; a filter on it prunes folders."""
        numbers = {f: n for n, (_, folders) in enumerate(self.parts, start=1) for f in folders}
        rows = self._rows(list(numbers)).withColumn(BUCKET, F.lit(None).cast("int"))
        if numbers:
            number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
            rows = rows.withColumn(BUCKET, number[F.col(PART)])
        return rows.drop(PART)

    def switched_out(self, archive: str) -> DataFrame:
        """The rows of a partition that was switched out under this name."""
        return self._rows(self.archives[archive]).drop(PART)

    def split(self, boundary: Column) -> PartitionedTable:
        """Cut the partition that holds ``boundary`` in two. Only its rows are written anew."""
        at = self._value(boundary)
        n = max(i for i, (low, _) in enumerate(self.parts) if low is None or low <= at)
        low, folders = self.parts[n]
        if low == at:
            raise ValueError("there is a partition that begins here")
        lower, upper = [], []
        if folders:
            lower, upper = [self._new_folder()], [self._new_folder()]
            above = F.col(self.column) >= F.lit(at).cast(self._kind())
            rows = self._rows(folders).withColumn(PART, F.when(above, upper[0]).otherwise(lower[0]))
            rows.hint("rebalance", PART).write.partitionBy(PART).mode("append").parquet(f"{self.path}/data")
            lower, upper = ([f for f in side if self._written(f)] for side in (lower, upper))
        return self._published([*self.parts[:n], (low, lower), (at, upper), *self.parts[n + 1 :]], self.archives)

    def merge(self, bucket: int, filled: bool = False) -> PartitionedTable:
        """Remove the boundary between this partition and the next. Refused while this one
        has rows, unless ``filled``; no row is written anew."""
        n = self._place(bucket)
        if n + 1 == len(self.parts):
            raise ValueError("the last partition has no next one")
        if not filled and not self._empty(n):
            raise ValueError(f"partition {bucket} is not empty")
        (low, lower), (_, upper) = self.parts[n], self.parts[n + 1]
        return self._published([*self.parts[:n], (low, lower + upper), *self.parts[n + 2 :]], self.archives)

    def switch_in(self, staged: DataFrame, bucket: int) -> PartitionedTable:
        """Make staged rows an empty partition, after a check of its bounds. Columns are
        matched by name."""
        n = self._place(bucket)
        value, kind = F.col(self.column), self._kind()
        low, high = self.parts[n][0], self.parts[n + 1][0] if n + 1 < len(self.parts) else None
        inside = F.lit(True)
        if low is not None:
            inside = inside & F.coalesce(value >= F.lit(low).cast(kind), F.lit(False))
        if high is not None:
            inside = inside & F.coalesce(value < F.lit(high).cast(kind), F.lit(low is None))
        if not staged.where(~inside).isEmpty():
            raise ValueError("staged rows outside the partition bounds")
        if not self._empty(n):
            raise ValueError(f"partition {bucket} is not empty")
        folder = self._new_folder()
        fitting = staged.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        fitting.write.parquet(f"{self.path}/data/{PART}={folder}")
        return self._published([*self.parts[:n], (low, [folder]), *self.parts[n + 1 :]], self.archives)

    def switch_out(self, bucket: int, archive: str) -> PartitionedTable:
        """Move the rows of a partition to an archive, by the list alone: they leave the one
        and appear in the other in one step."""
        n = self._place(bucket)
        if archive in self.archives:
            raise ValueError(f"there is an archive {archive!r}")
        low, folders = self.parts[n]
        return self._published([*self.parts[:n], (low, []), *self.parts[n + 1 :]], {**self.archives, archive: folders})

    def clean(self) -> None:
        """Remove the folders that this, the newest list does not name, and the older lists.
        Readers of older lists and changes under way must have ended."""
        if max(int(n) for n in subfolders(self.spark, f"{self.path}/lists")) != self.version:
            raise RuntimeError("there is a newer list")
        named = {f for _, folders in self.parts for f in folders} | {f for folders in self.archives.values() for f in folders}
        for n in subfolders(self.spark, f"{self.path}/lists"):
            if int(n) < self.version:
                remove(self.spark, f"{self.path}/lists/{n}")
        for folder in subfolders(self.spark, f"{self.path}/data"):
            if folder.removeprefix(f"{PART}=") not in named:
                remove(self.spark, f"{self.path}/data/{folder}")

    def _kind(self) -> T.DataType:
        return self.schema[self.column].dataType

    def _value(self, boundary: Column):
        value = self.spark.range(1).select(boundary.cast(self._kind())).first()[0]
        if value is None:
            raise ValueError("a boundary must not be null")
        return value

    def _place(self, bucket: int) -> int:
        if not 1 <= bucket <= len(self.parts):
            raise ValueError(f"there is no partition {bucket}")
        return bucket - 1

    def _empty(self, n: int) -> bool:
        return self._rows(self.parts[n][1]).isEmpty()

    def _new_folder(self) -> str:
        return f"p{uuid.uuid4().hex}"

    def _written(self, folder: str) -> bool:
        return exists(self.spark, f"{self.path}/data/{PART}={folder}")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(PART, T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{PART}={f}" for f in folders])

    def _published(self, parts: list, archives: dict) -> PartitionedTable:
        """The table after the next list took effect."""
        schema = T.StructType([
            T.StructField("column", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("low", self._kind()),
            T.StructField("folders", T.ArrayType(T.StringType())), T.StructField("archive", T.StringType()),
        ])
        rows = [(self.column, n, low, folders, None) for n, (low, folders) in enumerate(parts)]
        rows += [(self.column, None, None, folders, name) for name, folders in archives.items()]
        draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(draft)
        rename_new(self.spark, draft, f"{self.path}/lists/{self.version + 1}")
        return PartitionedTable(self.spark, self.path)
