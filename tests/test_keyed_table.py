"""Incremental writes: first row of a key wins, and a run may stop anywhere."""

import glob
import os
import shutil

import pytest

from quire.session import path_exists, remove_stages
from quire.sources import keyed_table as K

N = 8


def _df(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def _rows(spark, path, buckets=N):
    return sorted((tuple(r) for r in K.read_keyed(spark, path, buckets).collect()), key=repr)


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket_of_{N}=*/*.parquet")}


def test_first_row_of_a_key_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    K.add_new(_df(spark, [("a", 2), ("a", 1), (None, 5), ("b", 3)]), path, "k", N, ["v"])
    assert _rows(spark, path) == sorted([("a", 1), (None, 5), ("b", 3)], key=repr)
    for _ in range(2):
        K.add_new(_df(spark, [("a", 0), (None, 0), ("c", 4), ("c", 4)]), path, "k", N)
    assert _rows(spark, path) == sorted([("a", 1), (None, 5), ("b", 3), ("c", 4)], key=repr)


def test_only_buckets_that_gain_a_row_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    K.add_new(_df(spark, [(f"k{i}", i) for i in range(200)]), path, "k", N)
    before = _files(path)
    assert len({os.path.dirname(f) for f in before}) == N
    K.add_new(_df(spark, [("k1", 7), ("new", 1)]), path, "k", N)
    after = _files(path)
    changed = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert len(changed) == 1
    K.add_new(_df(spark, [("k1", 7), ("new", 1)]), path, "k", N)
    assert _files(path) == after


def test_a_run_cut_before_the_mark_changed_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    K.add_new(_df(spark, [("a", 1)]), path, "k", N)
    assert K.prepare(_df(spark, [("b", 2)]), path, "k", N)
    remove_stages(spark, [f"{path}/_ready"])
    K.add_new(_df(spark, [("c", 3)]), path, "k", N)
    assert _rows(spark, path) == [("a", 1), ("c", 3)]
    assert not path_exists(spark, f"{path}/_pending")


@pytest.mark.parametrize("lost", [0, 1, 3, N])
def test_a_run_cut_while_buckets_are_replaced_is_finished(spark, tmp_path, lost):
    path = str(tmp_path / "t")
    K.add_new(_df(spark, [(f"a{i}", i) for i in range(60)]), path, "k", N)
    assert K.prepare(_df(spark, [(f"b{i}", i) for i in range(60)]), path, "k", N)
    for folder in sorted(glob.glob(f"{path}/bucket_of_{N}=*"))[:lost]:  # removed, not yet put in place
        shutil.rmtree(folder)
    K.add_new(_df(spark, [("a1", -1), ("b1", -1), ("c", 0)]), path, "k", N)
    assert _rows(spark, path) == sorted([(f"{x}{i}", i) for x in "ab" for i in range(60)] + [("c", 0)])


def test_first_run_cut_before_any_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    assert K.prepare(_df(spark, [("a", 1)]), path, "k", N)
    K.add_new(_df(spark, [("a", 2), ("b", 2)]), path, "k", N)
    assert _rows(spark, path) == [("a", 1), ("b", 2)]


def test_other_layouts_are_errors(spark, tmp_path):
    path = str(tmp_path / "t")
    K.add_new(_df(spark, [("a", 1)]), path, "k", N)
    for bad, n in ((_df(spark, [("b", 1)]), N + 1), (_df(spark, [("b", 1.0)], "k string, w double"), N)):
        with pytest.raises(ValueError):
            K.add_new(bad, path, "k", n)
    with pytest.raises(ValueError):
        K.add_new(_df(spark, [("b", 1)]), path, "missing", N)
    plain = str(tmp_path / "plain")
    _df(spark, [("a", 1)]).write.parquet(plain + "/sub")
    with pytest.raises(ValueError):
        K.add_new(_df(spark, [("b", 1)]), plain, "k", N)
    assert _rows(spark, path) == [("a", 1)]


def test_empty_runs_and_odd_column_names(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "`x.y` int, row string, k int, b int, first array<int>"
    K.add_new(spark.createDataFrame([], schema), path, "x.y", N)
    assert not glob.glob(f"{path}/bucket*")
    K.add_new(spark.createDataFrame([(1, "r", 2, 3, [4])], schema), path, "x.y", N)
    K.add_new(spark.createDataFrame([], schema), path, "x.y", N)
    K.add_new(spark.createDataFrame([(2, None, 2, 3, None), (1, "z", 0, 0, [0])], schema), path, "x.y", N)
    assert _rows(spark, path) == [(1, "r", 2, 3, [4]), (2, None, 2, 3, None)]
