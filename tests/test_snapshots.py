"""Commits of whole sets of tables: a job that ends anywhere leaves the old or the new set."""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cratewise.plans import build as plan
from cratewise.sources.sinks import TARGETS, read_target, read_targets
from cratewise.sources.snapshots import SnapshotStore
from verification.registry import write_dump

NAMES = ("one", "two", "three")
STEPS = ("_write", "_rename", "_delete")


class Killed(BaseException):
    """The end of a job that leaves no time to clean up."""


def publish(spark, root, value, version=None, keep=2, kill_before=None):
    """Write a set whose tables all hold ``value``; end before the given step."""
    store, steps = SnapshotStore(spark, root), []

    def counted(run):
        def step(*args):
            if len(steps) == kill_before:
                raise Killed
            steps.append(run)
            return run(*args)

        return step

    for name in STEPS:
        setattr(store, name, counted(getattr(store, name)))
    folder = store.new_folder()
    write = counted(lambda name: spark.range(3).select(F.lit(value).alias("v")).write.parquet(f"{folder}/{name}"))
    for name in NAMES:
        write(name)
    store.commit(folder, NAMES, version)
    store.expire(keep)
    return len(steps)


def seen(spark, root, version=None):
    store = SnapshotStore(spark, root)
    snapshot = store.latest()
    paths = [store.table_path(snapshot, name, version) for name in NAMES]
    rows = [spark.read.parquet(path).collect() for path in paths]
    assert all(len(r) == 3 for r in rows)
    return {row.v for r in rows for row in r}


def test_a_job_that_ends_anywhere_leaves_one_whole_set(spark, tmp_path):
    root = str(tmp_path / "out")
    for value in (1, 2, 3):  # so that the next commit also expires something
        steps = publish(spark, root, value)
    current, outcomes = 3, []
    for kill_before in range(steps):
        with pytest.raises(Killed):
            publish(spark, root, 10 + kill_before, kill_before=kill_before)
        found = seen(spark, root)
        assert found in ({current}, {10 + kill_before})
        outcomes.append(found == {current})
        current = found.pop()
    # Nothing shows before the rename, everything after it.
    assert outcomes == [True] * (len(NAMES) + 2) + [False] * (steps - len(NAMES) - 2)
    publish(spark, root, 99)
    assert seen(spark, root) == {99}


def test_versions_live_side_by_side(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError, match="no table one"):
        seen(spark, root)
    publish(spark, root, 1, "a")
    publish(spark, root, 2, "b")
    publish(spark, root, 3, "a")
    publish(spark, root, 4)
    assert seen(spark, root, "a") == {3} and seen(spark, root, "b") == {2} and seen(spark, root) == {4}
    with pytest.raises(FileNotFoundError, match="version c"):
        seen(spark, root, "c")


def test_commits_at_once_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: publish(spark, root, i, f"v{i}", keep=50), range(8)))
    assert all(seen(spark, root, f"v{i}") == {i} for i in range(8))
    assert SnapshotStore(spark, root).latest().number == 8


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store._write("first", "_snapshots", "x")
    store._write("second", "_snapshots", "y")
    assert not store._rename(("_snapshots", "x"), ("_snapshots", "y"))
    assert (tmp_path / "_snapshots" / "y").read_text() == "second"


def test_readers_of_a_replaced_set_may_finish(spark, tmp_path):
    root = str(tmp_path / "out")
    publish(spark, root, 1)
    store = SnapshotStore(spark, root)
    old = spark.read.parquet(store.table_path(store.latest(), "one"))
    publish(spark, root, 2)
    assert old.count() == 3
    publish(spark, root, 3)
    assert len(list((tmp_path / "out" / "data").iterdir())) == 2
    with pytest.raises(ValueError, match="must stay"):
        store.expire(0)


def test_abandoned_sets_are_removed_by_age(spark, tmp_path):
    root = str(tmp_path / "out")
    publish(spark, root, 1)
    with pytest.raises(Killed):
        publish(spark, root, 2, kill_before=2)
    store = SnapshotStore(spark, root)
    assert store.remove_orphans() == []
    for folder in Path(root, "data").iterdir():
        os.utime(folder, (time.time() - 1e6, time.time() - 1e6))
    assert len(store.remove_orphans()) == 1 and seen(spark, root) == {1}


def test_a_build_shows_all_tables_or_none(spark, tmp_path, monkeypatch):
    dump, out = str(tmp_path / "dump"), str(tmp_path / "out")
    write_dump(spark, "/root/testdata/sf0.001", dump)
    plain = plan.write_target

    def failing(df, path, *args, **kwargs):
        if path.endswith("/text_lookup"):
            raise OSError("disk is full")
        plain(df, path, *args, **kwargs)

    monkeypatch.setattr(plan, "write_target", failing)
    with pytest.raises(OSError, match="disk is full"):
        plan.build(spark, dump, out)
    with pytest.raises(FileNotFoundError):
        read_target(spark, out, "recording")
    assert not any(Path(out, "data").glob("*"))
    monkeypatch.setattr(plan, "write_target", plain)
    plan.build(spark, dump, out)
    found = read_targets(spark, out)
    assert set(found) == set(TARGETS) and all(df.count() for df in found.values())
