import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quire.operators import corrections, knn, scoring, vocab
from tests.conftest import text_df

NONWORD_TEXT = 'The old "ladnar" hung over a narrow stair, and qwrxzt did not.'
DICTIONARY = "the old hung over a narrow stair and did not ladder lantern".split()
VECTORS = {
    "ladnar": [1.0, 0.0, 0.0],
    "ladnax": [0.99, 0.14, 0.0],     # closest, but not a dictionary word
    "ladder": [0.9, 0.43, 0.0],
    "lantern": [0.7, 0.0, 0.71],       # similar, in the dictionary, not close in spelling
    "stair": [0.0, 1.0, 0.0],
}


def _wv(spark):
    return spark.createDataFrame([(w, [float(x) for x in v]) for w, v in VECTORS.items()],
                                 "word string, vector array<float>")


def test_nonword_golden(spark):
    docs = text_df(spark, [("testfile", NONWORD_TEXT)])
    dic = spark.createDataFrame([(w,) for w in DICTIONARY], ["word"])
    nonwords = corrections.corpus_words(docs).join(dic, "word", "left_anti")
    corr = corrections.derive_corrections(nonwords, _wv(spark), dic)
    assert {(r["nonword"], r["good_word"]) for r in corr.collect()} == {("ladnar", "ladder")}
    out = corrections.replace_nonwords(docs, dic, corr).first()["text"]
    assert out == "the old ladder hung over a narrow stair and did not"


def test_floor_variant_is_stricter(spark):
    docs = text_df(spark, [("testfile", NONWORD_TEXT)])
    dic = spark.createDataFrame([(w,) for w in DICTIONARY], ["word"])
    nonwords = corrections.corpus_words(docs).join(dic, "word", "left_anti")
    corr = corrections.derive_corrections(nonwords, _wv(spark), dic, rounding="floor")
    assert corr.count() == 0


def test_replace_keeps_order_and_empty_docs(spark):
    docs = text_df(spark, [("a", "b a b"), ("z", "qq rr")])
    dic = spark.createDataFrame([("a",), ("b",)], ["word"])
    corr = spark.createDataFrame([], "nonword string, good_word string, similarity double")
    out = {r["doc_id"]: r["text"] for r in corrections.replace_nonwords(docs, dic, corr).collect()}
    assert out == {"a": "b a b", "z": ""}


def _brute(vecs, ids, k):
    m = np.array(vecs, dtype=np.float64)
    m = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = m @ m.T
    out = {}
    for i, q in enumerate(ids):
        cands = sorted(((-s[i, j], ids[j]) for j in range(len(ids)) if ids[j] != q))[:k]
        out[q] = [c for _, c in cands]
    return out


def test_knn_exact_across_blocks(spark):
    rng = np.random.default_rng(3)
    vecs = rng.standard_normal((157, 8)).round(1)
    vecs[5] = vecs[9]                       # exact tie
    ids = list(range(157))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vecs)],
                               "id long, vector array<double>")
    nb = knn.top_k_neighbors(df, df, k=7, block_rows=16)
    got = {}
    for r in nb.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["cid"])
    assert got == _brute(vecs, ids, 7)


def test_neighbor_histogram_includes_zero(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.99, 0.1]), (3, [0.0, 1.0])],
                               "id long, vector array<double>")
    nb = knn.top_k_neighbors(df, df, k=2)
    counts = {r["qid"]: r["n_near"] for r in knn.neighbor_counts(df, nb, 0.9).collect()}
    assert counts == {1: 1, 2: 1, 3: 0}
    hist = [(r["n_near"], r["count"]) for r in knn.neighbor_histogram(knn.neighbor_counts(df, nb, 0.9)).collect()]
    assert hist == [(0, 1), (1, 2)]


def test_keyword_scores(spark):
    docs = text_df(spark, [("d1", "ladnar ladder lantern stair"), ("d2", "a an"), ("d3", "unknownword")])
    scores = scoring.keyword_scores(docs, _wv(spark), ["ladnar", "absent"])
    got = {r["doc_id"]: r["keyword_scores"] for r in scores.collect()}
    sims = [1.0, 0.9 / math.hypot(0.9, 0.43), 0.7 / math.hypot(0.7, 0.71), 0.0]
    assert got["d1"] == {"ladnar": round(100 * sum(sims) / 4)}
    assert got["d2"] == {"ladnar": 0}            # no long words: trivial scores
    assert got["d3"] == {"ladnar": 0}            # word without a vector counts as 0
    ranges = {r["word"]: (r["min_score"], r["max_score"]) for r in scoring.score_ranges(scores).collect()}
    assert ranges == {"ladnar": (0, got["d1"]["ladnar"])}
    assert isinstance(got["d1"]["ladnar"], int)


def test_sampled_scores_are_deterministic(spark):
    text = " ".join(f"word{i:03d}" for i in range(200))
    docs = text_df(spark, [("d", text)])
    toks = docs.select(scoring.T.sample_tokens(scoring.T.tokenize(F.col("text")), 0.1, 5, F.col("doc_id")).alias("s"))
    a = toks.first()["s"]
    b = toks.first()["s"]
    assert a == b and len(a) == 20 and a == sorted(a)      # text order restored
    assert set(a) <= set(text.split())


def test_rank_words_dense_and_ordered(spark):
    rows = [(f"w{i:04d}", i % 37) for i in range(3000)]
    freq = spark.createDataFrame(rows, "word string, df long")
    ranked = vocab.rank_words(freq).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = sorted(ranked, key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(3000))
    assert [r["word"] for r in got] == [w for w, _ in want]


def test_term_frequency(spark):
    docs = text_df(spark, [("a", "The cat; the hat."), ("b", "cat cat")])
    got = {r["word"]: (r["tf"], r["df"]) for r in vocab.term_frequency(docs).collect()}
    assert got == {"the": (2, 1), "cat": (3, 2), "hat": (1, 1)}
    assert {r["word"] for r in vocab.term_frequency(docs, min_frequency=1).collect()} == {"the", "cat"}


def test_neighbor_density_sampled(spark):
    rng = np.random.default_rng(5)
    vecs = rng.standard_normal((60, 4))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "id long, vector array<double>")
    full = knn.neighbor_density(df, every=1, topn=5, threshold=0.5)
    assert sum(r["count"] for r in full.collect()) == 60
    sampled = knn.neighbor_density(df, every=3, topn=5, threshold=0.5).collect()
    import hashlib
    n_sampled = sum(int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 3 == 0 for i in range(60))
    assert sum(r["count"] for r in sampled) == n_sampled


def test_corrections_round_trip(spark, tmp_path):
    from quire.sources import files, sinks
    corr = spark.createDataFrame([("ladnar", "ladder", 0.9)], "nonword string, good_word string, similarity double")
    sinks.write_corrections(corr, str(tmp_path), "model-1")
    back = files.read_corrections(spark, str(tmp_path), "model-1")
    assert back.collect()[0]["good_word"] == "ladder"
    assert files.read_corrections(spark, str(tmp_path), "absent") is None


def test_knn_queries_distinct_from_candidates(spark):
    rng = np.random.default_rng(8)
    vecs = rng.standard_normal((90, 6)).round(1)
    ids = list(range(90))
    cands = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vecs)],
                                  "id long, vector array<double>")
    queries = cands.where("id % 3 = 0")
    nb = knn.top_k_neighbors(queries, cands, k=5, block_rows=8)
    got = {}
    for r in nb.orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["cid"])
    want = {q: v for q, v in _brute(vecs, ids, 5).items() if q % 3 == 0}
    assert got == want


def test_row_index_with_other_columns(spark):
    """Dense numbers whatever columns ride along, for skewed and sorted input."""
    rows = [(i, "hot" if i % 3 else f"k{i}", float(i % 11), "x" * (i % 50)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, k string, v double, pad string").repartition(7, "k")
    for order in ([F.col("v").desc(), F.col("id")], None):
        for source in (df, df.orderBy("v", "id")):
            got = vocab.with_row_index(source, "n", order)
            assert got.columns == df.columns + ["n"]
            assert sorted(r["n"] for r in got.collect()) == list(range(4000))
    want = sorted(rows, key=lambda r: (-r[2], r[0]))
    got = vocab.with_row_index(df, "n", [F.col("v").desc(), F.col("id")]).orderBy("n").select("id").collect()
    assert [r["id"] for r in got] == [r[0] for r in want]


def test_keywords_listed_twice_in_the_model(spark):
    wv = spark.createDataFrame([("cotton", [1.0, 0.0]), ("cotton", [1.0, 0.0]), ("wars", [0.0, 1.0]), ("none", [0.0, 0.0])],
                               "word string, vector array<float>")
    docs = text_df(spark, [("a", "cotton wars wars none"), ("b", "unknown"), ("c", "")])
    got = {r["doc_id"]: r["keyword_scores"] for r in
           scoring.keyword_scores(docs, wv, ["cotton", "wars", "missing"]).collect()}
    assert got == {"a": {"cotton": 25, "wars": 50}, "b": {"cotton": 0, "wars": 0}, "c": {"cotton": 0, "wars": 0}}


def test_zero_vectors(spark):
    from quire.functions import vectors as V
    from quire.operators import layout
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [1.0, 0.0])], "doc_id long, vector array<double>")
    got = {r["doc_id"]: r["x"] for r in layout.random_projection(df, 2).collect()}
    assert got[1] is None and got[2] is not None
    assert {r["doc_id"]: r["x"] is None for r in layout.pca_projection(df).collect()} == {1: True, 2: False, 3: False}
    sim = df.select(V.cosine("vector", F.array(F.lit(1.0), F.lit(0.0))).alias("s")).collect()
    assert [round(r["s"], 6) for r in sim] == [0.0, 0.6, 1.0]


def test_cells_method_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 16)) * 2
    vecs = centres[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vector array<double>")
    queries = df.where("id % 20 = 0")
    exact = {(r["qid"], r["cid"]) for r in knn.top_k_neighbors(queries, df, k=10).collect()}
    near = {(r["qid"], r["cid"]) for r in knn.top_k_neighbors(queries, df, k=10, method="cells", n_cells=24,
                                                              n_probe=6).collect()}
    assert len(near & exact) / len(exact) >= 0.9


def test_ties_are_broken_by_id_across_partitions(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)], "id long, vector array<double>").repartition(9)
    got = knn.top_k_neighbors(df.where("id in (3, 40)"), df, k=4).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["cid"]) for r in got] == [(3, 0), (3, 1), (3, 2), (3, 4), (40, 0), (40, 1), (40, 2), (40, 3)]


def _clustered(spark, n=1500, d=12, seed=11, hot=0.35):
    """Vectors around 20 directions, a third of them around the first."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((20, d))
    own = np.where(rng.random(n) < hot, 0, rng.integers(0, 20, n))
    vecs = (centres[own] + 0.4 * rng.standard_normal((n, d))).round(3)
    return vecs, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vector array<double>")


def test_join_by_cell_with_every_cell_is_exact(spark, monkeypatch):
    """Cells dealt over many tiles, queries in several blocks."""
    monkeypatch.setattr(knn, "TILE_ROWS", 50)
    monkeypatch.setattr(knn, "LEAST_TILE_ROWS", 20)
    vecs, df = _clustered(spark, 600)
    index = knn.cell_index(df, 9)
    asked = df.where("id % 20 = 0")
    got = {}
    for r in knn.search_cells(asked, index, 6, len(index.centres), block_rows=7).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["cid"])
    want = _brute(vecs, list(range(600)), 6)
    assert got == {q: want[q] for q in range(0, 600, 20)}


def test_probed_cells_reach_the_recall(spark):
    _, df = _clustered(spark)
    asked = df.where("id % 20 = 0")
    exact = {(r["qid"], r["cid"]) for r in knn.top_k_neighbors(asked, df, k=10).collect()}
    found = {(r["qid"], r["cid"]) for r in knn.search_cells(asked, knn.cell_index(df, 24), 10, 6).collect()}
    assert len(exact) == 750 and len(exact & found) / len(exact) >= 0.9


def test_only_probed_cells_are_read(spark, monkeypatch):
    """The plan filters the index's folders, and no query row is collected."""
    from pyspark.sql import DataFrame
    _, df = _clustered(spark)
    index = knn.cell_index(df, 24)
    asked = df.where("id = 7")
    collected, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(self.columns) or real(self))
    plan = knn.search_cells(asked, index, 5, 2)._jdf.queryExecution().toString()
    assert all("vector" not in c for c in collected)
    assert "PartitionFilters: [cell#" in plan or "PartitionFilters: [isnotnull(cell" in plan
    probed = real(index.rows.where("id = 7").select("cell"))[0]["cell"]
    assert f"cell#{plan.split('cell#')[1].split(' ')[0]}" and str(probed) in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_search_of_odd_rows(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 0.0]), ("c", None), ("a", [0.5, 0.5]), ("d", [1.0, 0.1])],
                               "id string, vector array<double>")
    got = [(r["qid"], r["cid"], round(r["sim"], 3)) for r in
           knn.top_k_neighbors(df.where("id in ('d', 'c', 'b')"), df, k=2).orderBy("qid", "rank").collect()]
    assert got == [("b", "a", 0.0), ("b", "a", 0.0), ("d", "a", 0.995), ("d", "a", 0.774)]
    empty = df.limit(0)
    for method in ("exact", "cells"):
        assert knn.top_k_neighbors(empty, df, k=2, method=method, n_cells=2).collect() == []
    assert knn.top_k_neighbors(df, empty, k=2).collect() == []


def test_recall_on_the_driver_vectors(spark):
    import os
    if not os.path.isdir("/root/testdata/sf0.1"):
        import pytest
        pytest.skip("driver tables absent")
    from quire.plans.all_queries import QUERIES
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        exact = {(r["qid"], r["cid"]) for r in QUERIES["knn_topk"](spark, sf).collect()}
        found = {(r["qid"], r["cid"]) for r in QUERIES["knn_topk_cells"](spark, sf).collect()}
        print(sf, len(exact & found) / len(exact))
        assert len(exact & found) / len(exact) >= 0.9


def test_pairs_of_tiles_and_blocks_are_bounded(spark, monkeypatch):
    """A task has a bounded part of both sides, however many queries there are."""
    for name, value in (("TILE_ROWS", 60), ("LEAST_TILE_ROWS", 20), ("QUERY_ROWS", 40), ("BATCH_ROWS", 16)):
        monkeypatch.setattr(knn, name, value)
    vecs, df = _clustered(spark, 400)
    dealt, real = [], type(df).mapInArrow

    def noted(self, *args, **kwargs):
        dealt.append(self)
        return real(self, *args, **kwargs)

    monkeypatch.setattr(type(df), "mapInArrow", noted)
    nb = knn.top_k_neighbors(df, df, k=6, block_rows=7).orderBy("qid", "rank").collect()
    got = {}
    for r in nb:
        got.setdefault(r["qid"], []).append(r["cid"])
    assert got == _brute(vecs, list(range(400)), 6)
    parts = dealt[0].rdd.mapPartitions(lambda rows: [[(r["tile"], r["side"]) for r in rows]]).collect()
    pairs = [{p for p, _ in part} for part in parts]
    assert len(set.union(*pairs)) >= 70 and sum(map(len, pairs)) == len(set.union(*pairs)) and max(map(len, pairs)) < 7
    counts = Counter(row for part in parts for row in part)
    assert all(n < 2 * (60 if side else 40) for (_, side), n in counts.items())


def test_best_of_equal_and_void_candidates():
    best = knn.Best(2, 2)
    for first in range(0, 12, 3):  # all equal: the first ones stay, later ones are not taken in
        best.add(np.array([[1.0, 1.0, 1.0], [-np.inf, -np.inf, 0.5]]), first)
    q, sim, c = best.cut()
    assert list(zip(q, sim, c)) == [(0, 1.0, 0), (0, 1.0, 1), (1, 0.5, 2), (1, 0.5, 5)]
    best = knn.Best(1, 3)
    best.add(np.array([[0.5, -np.inf]]), 0)
    best.add(np.array([[0.7, 0.1, 0.5, 0.9]]), 2)
    assert list(best.cut()[2]) == [5, 2, 0]


def test_sampled_positions_are_those_of_md5(spark):
    """The ranking of (key, position, seed) by md5, in Python: not in a sort of structs
    that Spark interprets token by token."""
    from hashlib import md5
    rows = [(1, [f"w{i}" for i in range(70_000)]), (2, ["a", "b", "a"]), (3, []), (4, None),
            (None, [f"n{i}" for i in range(15)])]
    docs = spark.createDataFrame(rows, "doc_id int, t array<string>")

    def want(key, toks):
        if toks is None:
            return None
        head = "" if key is None else f"{key}/"
        ranked = sorted((md5(f"{head}{i}/17".encode()).hexdigest(), i) for i in range(len(toks)))
        return [toks[i] for _, i in ranked[:round(len(toks) * 0.1)]]

    sampled = docs.select("doc_id", scoring.T.sample_tokens("t", 0.1, 17, F.col("doc_id"), keep_order=False).alias("s"))
    assert {r["doc_id"]: r["s"] for r in sampled.collect()} == {k: want(k, t) for k, t in rows}
    assert "md5" not in sampled._jdf.queryExecution().executedPlan().toString()


def test_norm_is_evaluated_once_for_a_vector(spark):
    from quire.functions import vectors as V
    wv = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 0.0]), ("c", [4.0, 3.0])], "word string, vector array<double>")
    sims = scoring.word_similarities(wv, scoring.base_vectors(wv, ["a"]))
    assert {r["word"]: r["sims"] for r in sims.collect()} == {"a": {"a": 1.0}, "b": {"a": 0.0}, "c": {"a": 0.96}}
    plan = wv.select(V.normalized("vector").alias("u"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 1


def test_corrected_texts_across_arrow_batches(spark):
    """Words are joined from a sorted stream, also where a document fills several batches."""
    dic = spark.createDataFrame([("good",), ("word",)], "word string")
    corr = spark.createDataFrame([("gud", "good")], "nonword string, good_word string")
    rows = [(1, "Gud word zzz " * 3000), (2, None), (3, "zzz"), (4, "word"), (None, "gud gud"), (5, ""), (4, "gud zzz")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert "collect_list" not in (out := corrections.replace_nonwords(docs, dic, corr))._jdf.queryExecution().toString()
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(got) == 6  # the rows of one key are one text, by place and word
    assert dict(got) == {1: " ".join(["good word"] * 3000), 2: "", 3: "", 4: "good word", None: "good good", 5: ""}
