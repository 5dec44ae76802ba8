"""Streaming forms of the change log, the sessions and the counter windows.

Each function takes a streaming DataFrame, runs until the available input is used
up and returns what was written, by this run and by earlier ones in the same folder.
The caller may name the folder for checkpoint, state and output; a run that was
stopped, or that failed, is continued by running it again with that folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.merging import require_unique
from millrace.plans.ordered import neighbours
from millrace.sources.tables import discard, is_file, materialise, work_path

MERGE_LOCALLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


#: Batches after which the state tables of a change log are added up.
FOLD_BATCHES = 32
#: Files a micro-batch takes at most, so that a large folder is many batches.
FILES_PER_BATCH = 1_000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A parquet file, or a folder of files, as a stream; new files are new input. A file
    source lists folders, so a single file is named by its folder and its exact name."""
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if not is_file(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(folder)


def _run_batches(stream: DataFrame, mode: str, folder: str, per_batch) -> None:
    """Run ``per_batch(rows, number)`` on every batch that is not done yet. What is done is
    kept in the checkpoint in ``folder``: a run that follows a stop or a failure goes on with
    the batch that was not finished, under the same number and with the same rows."""
    spark = stream.sparkSession
    state = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)  # state that outgrows the heap goes to disk
    try:
        query = (
            stream.writeStream.outputMode(mode)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(per_batch)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, state)
    query.awaitTermination()


def _write_once(df: DataFrame, path: str) -> None:
    """Write a table unless an earlier run has completed it."""
    if not is_file(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)


def _write_batches(stream: DataFrame, mode: str, name: str, folder: str | None) -> DataFrame:
    """All batches of all runs in ``folder`` (a fresh one without it), each in a folder of its
    own, so that a repeated batch replaces what it wrote before. An empty batch -1 fixes the
    schema, also when no input arrives."""
    spark = stream.sparkSession
    folder = folder or work_path(spark, name)
    out = f"{folder}/out"
    _write_once(spark.createDataFrame([], stream.schema), f"{out}/batch=-1")
    _run_batches(stream, mode, folder, lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
    return spark.read.parquet(out)


class ChangeLog:
    """Batches of change rows against a table whose state they change.

    The state is the stored table, overlaid by what earlier batches made of its keys. Each
    batch adds the last values of the keys it altered as a small table (``state/whole=0``)
    under its number, and reads only those of lower numbers: a repeated batch sees the same
    state and replaces its log and its state. Every ``FOLD_BATCHES`` batches the small tables
    are added up into one (``whole=1``), so a batch never reads more than that many.
    """

    def __init__(self, stored: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], folder: str):
        self.keys, self.columns, self.order, self.folder = list(keys), list(columns), list(order), folder
        self.stored = stored.select(*self.keys, F.struct(*self.columns).alias("_now"))
        _write_once(self.stored.where(F.lit(False)), f"{folder}/state/whole=1/batch=-1")

    def _last(self, batch: int) -> DataFrame:
        """Latest values of keys altered before ``batch``."""
        state = self.stored.sparkSession.read.parquet(f"{self.folder}/state").where(F.col("batch") < batch)
        folded = state.where("whole = 1").agg(F.max("batch")).first()[0]
        folded = -1 if folded is None else folded
        used = state.where((F.col("batch") > folded) & (F.col("whole") == 0) | (F.col("batch") == folded) & (F.col("whole") == 1))
        return used.groupBy(*self.keys).agg(F.max_by("_now", "batch").alias("_later"))

    def take(self, changes: DataFrame, batch: int) -> None:
        """Log the cells that a batch alters, and keep the state it leaves."""
        keys, order = self.keys, self.order
        changes = materialise(changes.select(*keys, *order, F.struct(*self.columns).alias("_new")), "batch")
        require_unique(changes, [*keys, *order])
        last = self._last(batch)
        touched = changes.select(*keys).distinct()
        opening = self.stored.join(touched, keys, "left_semi").join(last.join(touched, keys, "left_semi"), keys, "left")
        opening = materialise(opening.select(*keys, F.coalesce("_later", "_now").alias("_now")), "opening")
        met = neighbours(changes, keys, order or ["_new"], previous={"_before": "_new"}).join(opening, keys)
        met = met.select(*keys, *order, F.coalesce("_before", "_now").alias("_old"), "_new")
        cells = F.array(*[
            F.when(
                ~F.col("_old")[x].eqNullSafe(F.col("_new")[x]),
                F.struct(
                    F.lit(x).alias("column"),
                    F.col("_old")[x].cast("string").alias("old_value"),
                    F.col("_new")[x].cast("string").alias("new_value"),
                ),
            )
            for x in self.columns
        ])
        log = met.select(*keys, *order, F.inline(F.array_compact(cells)))
        log.write.mode("overwrite").parquet(f"{self.folder}/log/batch={batch}")
        newest = F.max_by("_new", F.struct(*order)) if order else F.first("_new")
        left = met.groupBy(*keys).agg(newest.alias("_now"))
        left.write.mode("overwrite").parquet(f"{self.folder}/state/whole=0/batch={batch}")
        if batch % FOLD_BATCHES == FOLD_BATCHES - 1:
            folded = self._last(batch + 1).withColumnRenamed("_later", "_now")
            folded = materialise(folded, "folded-state")
            folded.write.mode("overwrite").parquet(f"{self.folder}/state/whole=1/batch={batch}")
            discard(folded)
        for step in (changes, opening):
            discard(step)

    def read(self) -> DataFrame:
        return self.stored.sparkSession.read.parquet(f"{self.folder}/log")


def stream_change_log(
    changes: DataFrame,
    stored: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """Log the cells that change rows alter: key, ``column``, ``old_value``, ``new_value``,
    the columns ``order`` and the ``batch``.

    The old value is the one that the change before it left, in the same batch or an earlier
    one; the stored value, for the first change of a key. ``order`` names the columns that put
    the changes of one key inside a batch in order; without it, or where it does not tell two
    changes of a key apart, a batch may hold one change of a key and others are refused.
    Changes of keys that are not stored are not logged. NULLs compare as equal.

    ``folder`` keeps checkpoint, state and log. A later run with the same folder goes on
    where the last one ended, with the same ``stored`` table; without it a fresh one is used.
    """
    folder = folder or work_path(changes.sparkSession, "change-log")
    log = ChangeLog(stored, keys, columns, order, folder)
    if not is_file(changes.sparkSession, f"{folder}/log/batch=-1/_SUCCESS"):
        log.take(changes.sparkSession.createDataFrame([], changes.schema), -1)  # fixes the schema
    _run_batches(changes, "append", folder, log.take)
    return log.read()


def stream_sessions(
    events: DataFrame, key: str, at: str, gap: str, delay: str, folder: str | None = None
) -> DataFrame:
    """Sessions of a key that the watermark has closed. A later run with the same ``folder``
    takes the input that is new and knows the sessions that were still open.

    Sessions are merged inside each input partition before the shuffle, so a hot
    key sends its sessions, not its rows, to the state store.
    """
    spark = events.sparkSession
    before = spark.conf.get(MERGE_LOCALLY)
    spark.conf.set(MERGE_LOCALLY, "true")
    try:
        sessions = (
            events.withWatermark(at, delay)
            .groupBy(F.session_window(at, gap).alias("w"), key)
            .agg(F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count(F.lit(1)).alias("n_rows"))
            .drop("w")
        )
        out = _write_batches(sessions, "append", "sessions", folder)
    finally:
        spark.conf.set(MERGE_LOCALLY, before)
    return out.drop("batch")


def stream_counter_windows(
    events: DataFrame, key: str, at: str, width: str, delay: str, measure: str, folder: str | None = None
) -> DataFrame:
    """Count and sum per key and fixed interval, open intervals included: every
    batch writes the intervals it changed and the last one counts. A later run with the
    same ``folder`` takes the input that is new and goes on counting."""
    windows = (
        events.withWatermark(at, delay)
        .groupBy(F.window(at, width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(measure).alias("total"))
        .select(F.col("w.start").alias("started"), key, "n", "total")
    )
    written = _write_batches(windows, "update", "counter-windows", folder)
    last = written.groupBy("started", key).agg(F.max_by(F.struct("n", "total"), "batch").alias("v"))
    return last.select("started", key, "v.n", "v.total")
