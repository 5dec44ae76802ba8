"""Base tables and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Parquet tables of one directory, read lazily: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
        """Run SQL in which ``{orders}`` names a base table or a passed DataFrame."""
        named = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, args=args, **{**named, **frames})


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL_DIRS[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to a table under the shared folder and read it back. For
    inputs that are read several times: it cuts the lineage, survives the loss of
    executors, and tells the planner the size. ``discard`` removes it again."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored.millrace_path = path
    return stored


def _located(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether there is a file, not a folder, of this name."""
    path, files = _located(spark, path)
    return files.exists(path) and files.getFileStatus(path).isFile()


def exists(spark: SparkSession, path: str) -> bool:
    path, files = _located(spark, path)
    return files.exists(path)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    path, files = _located(spark, path)
    if not files.exists(path):
        return []
    return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]


def rename_new(spark: SparkSession, old: str, new: str) -> None:
    """Give a folder its final name, in one step; an error if the name is taken."""
    target, files = _located(spark, new)
    files.mkdirs(target.getParent())
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(_located(spark, old)[0], target, none)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    path, files = _located(spark, path)
    files.delete(path, True)


def discard(stored: DataFrame) -> None:
    """Delete what ``materialise`` wrote for this DataFrame; it cannot be read afterwards."""
    remove(stored.sparkSession, stored.millrace_path)
