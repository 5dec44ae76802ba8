"""Streams over files that arrive one after the other."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources.tables import discard, materialise, work_path
from millrace.streaming import streams as R

START = dt.datetime(2024, 1, 1)


def minutes(n):
    return START + dt.timedelta(minutes=n)


@pytest.fixture
def folder(spark):
    """Events of one busy and one quiet user, in two files."""
    path = work_path(spark, "stream-input")
    busy = [("busy", minutes(n), 1) for n in (*range(0, 30), *range(200, 230))]
    quiet = [("quiet", minutes(n), 2) for n in (5, 400)]
    schema = "who string, at timestamp, v int"
    spark.createDataFrame(busy, schema).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame(quiet, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).parquet(folder)


def test_closed_sessions(spark, folder, rows):
    out = R.stream_sessions(stream(spark, folder), "who", "at", "60 minutes", "1 minute")
    assert rows(out.select("who", "n_rows")) == [("busy", 30), ("busy", 30), ("quiet", 1)]


def test_counter_windows_include_open_ones(spark, folder, rows):
    out = R.stream_counter_windows(stream(spark, folder), "who", "at", "1 hour", "1 minute", "v")
    total = out.groupBy("who").agg(F.sum("n"), F.sum("total"))
    assert rows(total) == [("busy", 60, 60), ("quiet", 2, 4)]


def test_counter_windows_over_several_batches(spark, folder, rows):
    one_by_one = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = R.stream_counter_windows(one_by_one, "who", "at", "1 hour", "1 day", "v")
    assert rows(out.groupBy("who").agg(F.sum("n"))) == [("busy", 60), ("quiet", 2)]


def test_change_log_of_a_stream(spark, rows):
    path = work_path(spark, "stream-changes")
    spark.createDataFrame([(1, "b"), (2, "y")], "id int, x string").write.parquet(path)
    stored = spark.createDataFrame([(1, "a"), (2, "y"), (3, "z")], "id int, x string")
    changes = spark.readStream.schema("id int, x string").parquet(path)
    out = R.stream_change_log(changes, stored, ["id"], ["x"]).drop("batch")
    assert rows(out) == [(1, "x", "a", "b")]


def test_stream_without_input_gives_no_rows(spark):
    path = work_path(spark, "stream-empty")
    spark.createDataFrame([], "who string, at timestamp, v int").write.parquet(path)
    nothing = spark.readStream.schema("who string, at timestamp, v int").parquet(f"{path}/part-none*")
    assert R.stream_counter_windows(nothing, "who", "at", "1 hour", "1 minute", "v").count() == 0


def test_a_neighbour_with_a_longer_name_is_not_read(spark, tmp_path):
    for name in ("events.parquet", "events.parquet_old"):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / name))
    rows = R.read_stream(spark, str(tmp_path / "events.parquet"), spark.range(1).schema)
    assert not R._write_batches(rows, "append", "exact", None).count() > 3


def test_small_batches_and_late_rows(spark, tmp_path):
    """One file a batch, times mixed: what comes after its window was closed by the
    watermark (one hour behind the latest time seen) is dropped, the rest counts."""
    path, schema = str(tmp_path / "late"), "who string, at timestamp, v int"
    for n in (0, 300, 299, 30):  # the last is 270 minutes behind
        spark.createDataFrame([("a", minutes(n), 1)], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are read in the order of their times
    rows = R.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out = R.stream_counter_windows(rows, "who", "at", "1 hour", "1 hour", "v")
    assert sorted((r["started"], r["n"]) for r in out.collect()) == [(minutes(0), 1), (minutes(240), 1), (minutes(300), 1)]


def test_stored_tables_can_be_discarded(spark):
    stored = materialise(spark.range(5), "short-lived")
    assert stored.count() == 5
    discard(stored)
    with pytest.raises(Exception, match="(?i)exist"):
        spark.read.parquet(stored.millrace_path)


def arrive(spark, path, rows, schema):
    """One more file of a folder; files are read in the order of their times."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)


CHANGE = "id int, at int, x string, y int"
STORED = [(1, "A", 1), (2, "P", None), (3, "Z", 3)]
CHANGES = [
    [(1, 1, "B", 1), (9, 1, "new", 0)],
    [(1, 1, "C", 1), (1, 2, "C", 5), (1, 3, "D", None), (2, 1, "P", None)],
    [(1, 7, "D", None), (2, 5, "Q", 4), (None, 1, "B", 1)],
    [(2, 1, "Q", None), (1, 1, "A", 1)],
]
LOG = [
    (1, 1, "x", "A", "B", 0), (1, 1, "x", "B", "C", 1), (1, 2, "y", "1", "5", 1), (1, 3, "x", "C", "D", 1),
    (1, 3, "y", "5", None, 1), (2, 5, "x", "P", "Q", 2), (2, 5, "y", None, "4", 2), (2, 1, "y", "4", None, 3),
    (1, 1, "x", "D", "A", 3), (1, 1, "y", None, "1", 3),
]


@pytest.mark.parametrize("fold", [1, 2, 32])
def test_change_log_follows_the_state(spark, rows, monkeypatch, tmp_path, fold):
    monkeypatch.setattr(R, "FOLD_BATCHES", fold)
    path, stored = str(tmp_path / "in"), spark.createDataFrame(STORED, "id int, x string, y int")
    for batch in CHANGES:
        arrive(spark, path, batch, CHANGE)
    changes = R.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out = R.stream_change_log(changes, stored, ["id"], ["x", "y"], ["at"])
    assert rows(out.select("id", "at", "column", "old_value", "new_value", "batch")) == sorted(LOG, key=repr)


def test_a_repeated_batch_is_logged_once(spark, rows, tmp_path):
    stored = spark.createDataFrame(STORED, "id int, x string, y int")
    log = R.ChangeLog(stored, ["id"], ["x", "y"], ["at"], str(tmp_path / "log"))
    for number in (0, 0, 1, 2, 1, 2, 3, 3):
        log.take(spark.createDataFrame(CHANGES[number], CHANGE), number)
    out = log.read().select("id", "at", "column", "old_value", "new_value", "batch")
    assert rows(out) == sorted(LOG, key=repr)


def test_change_log_goes_on_after_a_stop_and_a_failure(spark, rows, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "in"), str(tmp_path / "folder")
    stored = spark.createDataFrame(STORED, "id int, x string, y int")

    def run():
        changes = R.read_stream(spark, path, spark.createDataFrame([], CHANGE).schema, files_per_batch=1)
        return R.stream_change_log(changes, stored, ["id"], ["x", "y"], ["at"], folder)

    arrive(spark, path, CHANGES[0], CHANGE)
    assert run().count() == 1
    arrive(spark, path, CHANGES[1], CHANGE)
    arrive(spark, path, CHANGES[2], CHANGE)
    take = R.ChangeLog.take

    def failing(self, df, batch):
        take(self, df, batch)  # all is written, but the batch does not end
        if batch == 1:
            raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(R.ChangeLog, "take", failing)
        with pytest.raises(Exception, match="lost"):
            run()
    assert run().where("batch > 1").count() == 2
    arrive(spark, path, CHANGES[3], CHANGE)
    run()
    assert rows(run().select("id", "at", "column", "old_value", "new_value", "batch")) == sorted(LOG, key=repr)


def test_two_changes_of_a_key_without_an_order_are_refused(spark, tmp_path):
    log = R.ChangeLog(spark.createDataFrame(STORED, "id int, x string, y int"), ["id"], ["x"], [], str(tmp_path))
    with pytest.raises(ValueError, match="several change rows"):
        log.take(spark.createDataFrame(CHANGES[1], CHANGE), 0)


@pytest.mark.parametrize("kind", ["sessions", "windows"])
def test_streams_go_on_after_a_stop(spark, rows, tmp_path, kind):
    """Files one by one, a run after each, against one uninterrupted run."""
    schema = "who string, at timestamp, v int"
    files = [
        [("a", minutes(n), 1) for n in range(0, 30)] + [("b", minutes(3), 2)],
        [("a", minutes(n), 1) for n in range(20, 50)],  # goes on with an open session and an open window
        [("b", minutes(300), 2), ("a", minutes(10), 1)],  # the second is late
        [("a", minutes(500), 1)],
    ]

    def run(path, folder):
        events = R.read_stream(spark, path, spark.createDataFrame([], schema).schema, files_per_batch=1)
        if kind == "sessions":
            return R.stream_sessions(events, "who", "at", "60 minutes", "1 minute", folder)
        return R.stream_counter_windows(events, "who", "at", "1 hour", "1 minute", "v", folder)

    whole, parts, folder = str(tmp_path / "whole"), str(tmp_path / "parts"), str(tmp_path / "state")
    for i, file in enumerate(files):
        arrive(spark, whole, file, schema)
        arrive(spark, parts, file, schema)
        if i != 1:  # the third run takes two files
            out = run(parts, folder)
    assert rows(out) == rows(run(whole, None)) == rows(run(parts, folder))
    assert out.count() == (3 if kind == "sessions" else 4)
