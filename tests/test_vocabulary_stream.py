"""Growing vocabulary: replayed, older, newer and repeated versions, against plain counts."""

from collections import Counter

from quire.streaming import vocabulary_stream as V
from quire.streaming.cleaning_stream import read_documents_stream

SCHEMA = "doc_id int, landed long, text string"


def _run(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{root}/in")
    V.update_vocabulary(read_documents_stream(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema),
                        f"{root}/out", f"{root}/check")


def _got(spark, root):
    return {r["word"]: (r["tf"], r["df"]) for r in V.read_vocabulary(spark, f"{root}/out").collect()}


def _want(texts):
    tf, df = Counter(), Counter()
    for t in texts:
        words = (t or "").split()
        tf.update(words)
        df.update(set(words))
    return {w: (tf[w], df[w]) for w in tf}


def test_newest_versions_count_once(spark, tmp_path):
    root = str(tmp_path)
    _run(spark, root, [(1, 1, "alpha beta beta"), (2, 1, "beta gamma"), (None, 1, "null key")])
    assert _got(spark, root) == _want(["alpha beta beta", "beta gamma", "null key"])
    _run(spark, root, [(1, 1, "alpha beta beta"), (1, 2, "alpha delta"), (1, 2, "alpha delta"), (3, None, "no version")])
    assert _got(spark, root) == _want(["alpha delta", "beta gamma", "null key"])
    V.compact(spark, f"{root}/out")
    assert _got(spark, root) == _want(["alpha delta", "beta gamma", "null key"])
    _run(spark, root, [(2, 5, None), (1, 1, "older"), (4, 1, ""), (5, 1, "word " * 3000)])
    want = _want(["alpha delta", "null key", "word " * 3000])
    assert _got(spark, root) == want
    for _ in range(2):
        V.compact(spark, f"{root}/out")
        assert _got(spark, root) == want


def test_compaction_cut_short(spark, tmp_path):
    root = str(tmp_path)
    _run(spark, root, [(1, 1, "alpha beta"), (2, 1, "beta")])
    V.compact(spark, f"{root}/out")
    _run(spark, root, [(1, 2, "alpha"), (3, 1, "gamma")])
    # the next sums were begun and not finished
    spark.createDataFrame([("junk", 9, 9)], V.DIFFERENCE).write.parquet(f"{root}/out/sums/upto=1")
    (tmp_path / "out" / "sums" / "upto=1" / "_SUCCESS").unlink()
    assert _got(spark, root) == _want(["alpha", "beta", "gamma"])
    V.compact(spark, f"{root}/out")
    assert _got(spark, root) == _want(["alpha", "beta", "gamma"])


def test_nothing_landed(spark, tmp_path):
    assert V.read_vocabulary(spark, str(tmp_path / "out")).collect() == []
    V.compact(spark, str(tmp_path / "out"))


def test_documents_do_not_reach_python_one_by_one(spark, tmp_path):
    """Counting per document was a Python call and a state row for each of them."""
    root = str(tmp_path)
    _run(spark, root, [(i, 1, f"alpha w{i % 7}") for i in range(50)])
    assert not (tmp_path / "check" / "state").exists()
    assert _got(spark, root) == _want([f"alpha w{i % 7}" for i in range(50)])


def test_batch_retried_at_any_point(spark, tmp_path):
    path = str(tmp_path / "out")

    def batch(rows):
        return spark.createDataFrame(rows, "key int, landed long, text string")

    first = batch([(1, 1, "alpha beta"), (2, 1, "beta"), (1, 1, "alpha alpha"), (None, 1, "null key")])
    second = batch([(1, 2, "gamma"), (2, 1, "beta"), (3, 1, None), (None, 2, "alpha")])
    want = _want(["gamma", "beta", "alpha"])
    V.take_in(first, 0, path)
    V.take_in(first, 0, path)
    # the greater of two texts of one version: two of a word before one
    assert {r["word"]: r["tf"] for r in V.read_vocabulary(spark, path).collect()} == {"alpha": 2, "beta": 1, "null": 1, "key": 1}
    for _ in range(2):
        V.take_in(second, 1, path)
        assert {r["word"]: (r["tf"], r["df"]) for r in V.read_vocabulary(spark, path).collect()} == want
    V.compact(spark, path)
    for again in (second, first):  # also after its sums and documents were compacted
        V.take_in(again, 1, path)
        assert {r["word"]: (r["tf"], r["df"]) for r in V.read_vocabulary(spark, path).collect()} == want
