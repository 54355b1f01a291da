"""Writes that fail or are killed half-way leave the earlier snapshot readable."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from snapvault import commits
from snapvault.operators.validation import count_exported
from snapvault.sinks.writers import write_full, write_incremental
from snapvault.sources.tables import scan_exported

SNAP, LATER = "20240101000000Z", "20240201000000Z"


def _failing(spark, n=1000):
    """Rows whose last one makes its task fail, after the others may have been written."""
    return spark.range(n).select("id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).alias("bad")).repartition(4)


class Killed(BaseException):
    """Stands for the driver's death: no clean-up runs after it."""


def _kill_at(monkeypatch, name):
    """Kill the writer where it calls ``name``: neither the step nor any clean-up happens."""
    def die(*args, **kwargs):
        monkeypatch.setattr(commits.Files, "delete", lambda self, name: False)
        raise Killed()
    monkeypatch.setattr(commits.Files if hasattr(commits.Files, name) else commits, name, die)


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_a_failing_rerun_keeps_the_old_rows(spark, tmp_dir, mode):
    path = os.path.join(tmp_dir, "t")

    def write(df):
        write_full(df, path) if mode == "full" else write_incremental(df, path, SNAP)
    write(spark.range(10))
    with pytest.raises(Exception, match="lost"):
        write(_failing(spark))
    for back in (spark.read.parquet(path), scan_exported(spark, path)):
        assert sorted(r["id"] for r in back.collect()) == list(range(10))
    write(spark.range(3))
    assert spark.read.parquet(path).count() == scan_exported(spark, path).count() == 3


@pytest.mark.parametrize("mode", ["full", "incremental"])
@pytest.mark.parametrize("step,rows", [("_move", 10), ("put_if_absent", 10), ("_drop_replaced", 3)])
def test_a_killed_write_leaves_one_whole_snapshot(spark, tmp_dir, monkeypatch, mode, step, rows):
    path = os.path.join(tmp_dir, "t")

    def write(n):
        write_full(spark.range(n), path) if mode == "full" else write_incremental(spark.range(n), path, SNAP)
    write(10)
    with monkeypatch.context() as m:
        _kill_at(m, step)
        with pytest.raises(Killed):
            write(3)
    assert scan_exported(spark, path).count() == rows
    counted = count_exported(spark, {"t": path}, mode, SNAP).first()["exported_row_count"]
    assert counted == rows
    write(5)  # the next write removes what the killed one left
    assert scan_exported(spark, path).count() == spark.read.parquet(path).count() == 5


def test_a_killed_first_write_is_no_table(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    with monkeypatch.context() as m:
        _kill_at(m, "put_if_absent")
        with pytest.raises(Killed):
            write_incremental(spark.range(3), path, SNAP)
    assert count_exported(spark, {"t": path}, "incremental", SNAP).first()["exported_row_count"] == 0
    left = commits.clean_table(spark, path, older_than_s=-60)
    assert left and not any(f.startswith("sv-") for _, _, fs in os.walk(path) for f in fs)


def test_other_snapshots_stay_when_one_write_is_killed(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    both = spark.range(4).withColumn("extraction_timestamp", F.when(F.col("id") < 1, SNAP).otherwise(LATER))
    write_incremental(both, path)
    with monkeypatch.context() as m:
        _kill_at(m, "put_if_absent")
        with pytest.raises(Killed):
            write_incremental(spark.range(100), path, LATER)
    got = {r[0]: r[1] for r in scan_exported(spark, path).groupBy("extraction_timestamp").count().collect()}
    assert got == {SNAP: 1, LATER: 3}
    assert scan_exported(spark, path, LATER).count() == 3


def test_of_two_writers_from_one_version_one_fails(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_incremental(spark.range(2), path, SNAP)
    version = commits.version_of(spark, path, SNAP)
    write_incremental(spark.range(5), path, SNAP, expected_version=version)
    with pytest.raises(commits.CommitConflict):
        write_incremental(spark.range(9), path, SNAP, expected_version=version)
    assert scan_exported(spark, path).count() == spark.read.parquet(path).count() == 5
    # and in parallel: as many commits as did not conflict, and one whole result
    done = []

    def write(n):
        try:
            write_incremental(spark.range(n), path, SNAP)
            done.append(n)
        except commits.CommitConflict:
            pass
    threads = [threading.Thread(target=write, args=(n,)) for n in (11, 12, 13)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert done and scan_exported(spark, path).count() in done
    assert commits.version_of(spark, path, SNAP) == 2 + len(done)


def test_snapshots_without_a_log_are_read_as_they_are(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(7).write.parquet(f"{path}/extraction_timestamp={SNAP}")
    assert scan_exported(spark, path).count() == 7
    write_incremental(spark.range(2), path, LATER)
    assert scan_exported(spark, path).count() == 9 and scan_exported(spark, path, SNAP).count() == 7
    assert {r["extraction_timestamp"]: r["exported_row_count"] for r in count_exported(spark, {"t": path}).collect()} == {SNAP: 7, LATER: 2}
    write_incremental(spark.range(1), path, SNAP)
    assert scan_exported(spark, path).count() == 3
    commits.forget_snapshot(spark, path, SNAP)
    assert scan_exported(spark, path).count() == 2


def test_full_mode_replaces_snapshots_and_refuses_them_afterwards(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_incremental(spark.range(3), path, SNAP)
    write_full(spark.range(4), path + "/")
    assert scan_exported(spark, path).count() == 4 and not os.path.exists(f"{path}/extraction_timestamp={SNAP}")
    with pytest.raises(ValueError, match="full mode"):
        write_incremental(spark.range(3), path, SNAP)
