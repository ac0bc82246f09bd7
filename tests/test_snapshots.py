"""Snapshots: commits, readers that keep theirs, failures without a trace, conflicts."""

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators import snapshots

SCHEMA = "k long, a string, b double"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def place(spark, tmp_path):
    path = str(tmp_path / "table")
    snapshots.create_table(spark.createDataFrame([(i, f"a{i}", float(i)) for i in range(40)], SCHEMA), path, "k", buckets=8)
    return path


def _batch(spark, rows):
    return spark.createDataFrame(rows, f"seq long, op string, {SCHEMA}")


def _data(tmp_path):
    return sorted(p.name for p in (tmp_path / "table" / "data").iterdir())


def test_commits_and_snapshots(spark, place, tmp_path):
    opened = snapshots.read_table(spark, place)
    first = _rows(opened)
    assert snapshots.commit_changes(spark, place, _batch(spark, [(1, "delete", 3, None, None), (2, "update", 4, None, -1.0), (3, "insert", 99, "new", None)])) == 1
    assert snapshots.commit_changes(spark, place, _batch(spark, [(1, "insert", 3, "back", 1.5)])) == 2
    assert _rows(opened) == first == _rows(snapshots.read_table(spark, place, 0))
    one, two = (_rows(snapshots.read_table(spark, place, n)) for n in (1, 2))
    assert one == sorted([r for r in first if r[0] not in (3, 4)] + [(4, "a4", -1.0), (99, "new", None)], key=str)
    assert two == sorted([*one, (3, "back", 1.5)], key=str) == _rows(snapshots.read_table(spark, place))
    before, after = (snapshots._manifest(spark, place, n)["places"] for n in (1, 2))
    assert sum(before.get(b) != after.get(b) for b in {*before, *after}) == 1  # one key, one bucket rewritten
    assert snapshots.commit_changes(spark, place, _batch(spark, [])) == 3
    assert _rows(snapshots.read_table(spark, place)) == two
    with pytest.raises(FileNotFoundError):
        snapshots.read_table(spark, place, 9)


def test_failed_batch_leaves_no_trace(spark, place, tmp_path):
    before, rows = _data(tmp_path), _rows(snapshots.read_table(spark, place))
    broken = _batch(spark, [(1, "update", i, "x", 1.0) for i in range(20)]).withColumn("a", F.when(F.col("k") == 13, F.raise_error(F.lit("broken"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="broken"):
        snapshots.commit_changes(spark, place, broken)
    assert _data(tmp_path) == before and snapshots.snapshots(spark, place) == [0]
    assert _rows(snapshots.read_table(spark, place)) == rows


def test_of_two_batches_one_commits(spark, place, tmp_path, monkeypatch):
    """Another batch takes the number between reading and committing."""
    real = snapshots.apply_changes

    def slow(*args):
        monkeypatch.setattr(snapshots, "apply_changes", real)
        snapshots.commit_changes(spark, place, _batch(spark, [(1, "delete", 1, None, None)]))
        return real(*args)

    monkeypatch.setattr(snapshots, "apply_changes", slow)
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit_changes(spark, place, _batch(spark, [(1, "delete", 2, None, None)]))
    keys = {r["k"] for r in snapshots.read_table(spark, place).collect()}
    assert 1 not in keys and 2 in keys and snapshots.snapshots(spark, place) == [0, 1]
    assert len(_data(tmp_path)) == 2
    assert snapshots.commit_changes(spark, place, _batch(spark, [(1, "delete", 2, None, None)])) == 2


def test_expire(spark, place, tmp_path):
    for i in range(3):
        snapshots.commit_changes(spark, place, _batch(spark, [(1, "update", i, "x", None)]))
    rows = _rows(snapshots.read_table(spark, place))
    (tmp_path / "table" / "data" / "left-over").mkdir()
    assert snapshots.expire(spark, place, keep=1) == [3] and _rows(snapshots.read_table(spark, place)) == rows
    assert "left-over" not in _data(tmp_path)
    with pytest.raises(FileNotFoundError):
        snapshots.read_table(spark, place, 1)


def test_empty_table_and_removed_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.create_table(spark.createDataFrame([], SCHEMA), path, "k")
    assert snapshots.read_table(spark, path).count() == 0
    snapshots.commit_changes(spark, path, _batch(spark, [(1, "insert", 1, "x", 1.0)]))
    snapshots.commit_changes(spark, path, _batch(spark, [(1, "delete", 1, None, None)]))
    assert [snapshots.read_table(spark, path, n).count() for n in range(3)] == [0, 1, 0]
    with pytest.raises(snapshots.CommitConflict):
        snapshots.create_table(spark.createDataFrame([], SCHEMA), path, "k")
