"""Trained word vectors against a dense decomposition, documents against a solve."""

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.text import tokenize
from quire.operators import subspace as S
from quire.sources.tables import table

SF = "/root/testdata/sf0.001"


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    topics = [[f"{t}{i}" for i in range(8)] for t in "abc"]
    return [(i, [rng.choice(topics[i % 3]) if rng.random() < 0.85 else "the" for _ in range(rng.randint(1, 40))])
            for i in range(n)] + [(90, []), (91, ["unseen"]), (92, None)]


def slow_cells(docs, words, window):
    n = Counter()
    for t in docs:
        for i, w in enumerate(t):
            for j in range(max(0, i - window), min(len(t), i + window + 1)):
                if i != j and w in words and t[j] in words:
                    n[w, t[j]] += 1
    total, rows = sum(n.values()), Counter()
    for (w, _), k in n.items():
        rows[w] += k
    return {p: v for p, k in n.items() if (v := math.log(k * total / (rows[p[0]] * rows[p[1]]))) > 0}


def slow_vectors(cells, words, size):
    at = {w: i for i, w in enumerate(words)}
    m = np.zeros((len(words), len(words)))
    for (w, c), v in cells.items():
        m[at[w], at[c]] = v
    values, axes = np.linalg.eigh(m)
    best = np.argsort(-np.abs(values))[:size]
    return axes[:, best] * np.sqrt(np.abs(values[best])), np.abs(values)


def cosines(v):
    """Of words outside the subspace (rounding noise only) 0."""
    n = np.linalg.norm(v, axis=1, keepdims=True)
    u = np.where(n > 1e-6, v / np.maximum(n, 1e-300), 0.0)
    return u @ u.T


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, tokens array<string>")


def trained(spark, docs, words, **options):
    got = {r["word"]: r["vector"] for r in S.train_subspace(frame(spark, docs), options).collect()}
    assert sorted(got) == words
    return np.array([got[w] for w in words])


def test_vectors_match_a_dense_decomposition(spark):
    docs = corpus()
    times = Counter(w for _, t in docs for w in t or [])
    words = sorted(w for w, k in times.items() if k >= 3)
    cells = slow_cells([t for _, t in docs if t], set(words), 4)
    got = {(r["word"], r["context"]): r["value"] for r in S.ppmi(S.cooccurrences(
        frame(spark, docs), spark.createDataFrame([(w,) for w in words], ["word"]), 4)).collect()}
    assert got.keys() == cells.keys() and all(abs(got[p] - cells[p]) < 1e-12 for p in cells)
    want, values = slow_vectors(cells, words, 5)
    values = np.sort(values)[::-1]
    errors = []
    for epochs in (1, 3, 20):
        vectors = trained(spark, docs, words, vectorSize=5, windowSize=4, minCount=3, maxIter=epochs)
        assert vectors.shape == want.shape
        errors.append(abs(cosines(vectors) - cosines(want)).max())
    assert errors[0] > errors[1] > errors[2] and errors[2] < 1e-6


def test_options_act(spark):
    docs = corpus(2)
    words = sorted(w for w, k in Counter(w for _, t in docs for w in t or []).items() if k >= 3)
    base = dict(vectorSize=4, windowSize=3, minCount=3, maxIter=1, seed=1)
    one = trained(spark, docs, words, **base)
    assert np.allclose(one, trained(spark, docs, words, **base))
    for change in ({"seed": 2}, {"maxIter": 3}, {"windowSize": 1}):
        assert not np.allclose(cosines(one), cosines(trained(spark, docs, words, **{**base, **change})), atol=1e-3)


def test_inferred_documents_equal_trained_ones(spark):
    """A document left out gets the vector it has when it is there."""
    docs = corpus(3)
    options = {"vectorSize": 4, "windowSize": 3, "minCount": 3, "maxIter": 5}
    model, everything = S.train_documents(spark, frame(spark, docs), options)
    trained_ = {r["doc_id"]: np.array(r["vector"]) for r in everything.collect()}
    assert len(trained_) == len(docs)
    alone = {r["doc_id"]: np.array(r["vector"]) for r in model.infer(frame(spark, docs[5:9])).collect()}
    for i, v in alone.items():
        assert abs(v - trained_[i]).max() < 1e-6
    words = {r["word"]: np.array(r["b"]) for r in model.words.collect()}
    v = np.array(list(words.values()))
    for i, t in docs:
        a = np.array([math.log1p((t or []).count(w)) for w in words])
        x = np.linalg.lstsq(np.vstack([v, np.eye(4)]), np.concatenate([a, np.zeros(4)]), rcond=None)[0]
        assert abs(x - trained_[i]).max() < 1e-8
    assert not trained_[90].any() and not trained_[91].any() and not trained_[92].any()


def test_few_words_and_no_documents(spark):
    got = S.train_subspace(frame(spark, [(1, ["a", "b", "a", "c"])]), {"vectorSize": 6, "minCount": 1, "maxIter": 2}).collect()
    assert sorted(r["word"] for r in got) == ["a", "b", "c"] and all(len(r["vector"]) == 6 for r in got)
    assert S.train_subspace(frame(spark, []), {"vectorSize": 3, "minCount": 1, "maxIter": 1}).collect() == []
    one = S.train_subspace(frame(spark, [(1, ["a"])]), {"vectorSize": 3, "minCount": 1, "maxIter": 1}).collect()
    assert [tuple(r) for r in one] == [("a", [0.0] * 3)]


def test_driver_words_match_a_dense_decomposition(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver tables absent")
    docs = table(spark, SF, "documents").select("doc_id", tokenize(F.col("text")).alias("tokens"))
    options = {"vectorSize": 3, "windowSize": 2, "minCount": 60, "maxIter": 25}
    got = {r["word"]: r["vector"] for r in S.train_subspace(docs, options).collect()}
    texts = [r["tokens"] for r in docs.collect()]
    words = sorted(w for w, k in Counter(w for t in texts for w in t).items() if k >= 60)
    want, values = slow_vectors(slow_cells(texts, set(words), 2), words, 3)
    assert sorted(got) == words and len(words) > 100
    assert abs(cosines(np.array([got[w] for w in words])) - cosines(want)).max() < 1e-6


@pytest.mark.parametrize("step", [1 << 18, 3])  # one step; steps that cut documents
def test_pairs_are_counted_once_in_each_task(step, monkeypatch):
    """F1, F3, F8: of two places one row is made, and of a pair one count."""
    import pyarrow as pa
    monkeypatch.setattr(S, "STEP_PLACES", step)
    row, doc, words = np.array([0, 2, -1, 2, 1, 0, 0]), np.array([0, 0, 0, 0, 1, 1, 1]), pa.array(["a", "b", "c"])
    codes = [S._pairs(row[a:a + step + 2], doc[a:a + step + 2], 2, 3) for a in range(0, len(row), step)]
    held = [np.unique(c, return_counts=True) for c in codes]
    got = [(r["word"], r["context"], r["n"]) for b in S._counted(words, held) for r in b.to_pylist()]
    assert sorted(got) == [("a", "a", 1), ("a", "b", 2), ("a", "c", 1), ("c", "c", 1)]


def folders(spark):
    from quire.session import ensure_checkpoint_dir
    place = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(place) if not f.startswith("rdd-")}


def left_over(spark, before):
    """Labels of the folders staged since."""
    return sorted(f.rpartition("-")[0] for f in folders(spark) - before)


@pytest.mark.parametrize("few, bucket, row", [(5, 150, 7), (1000, 1 << 20, 1 << 16)])  # many tiles, buckets and rows; one
def test_counts_and_vectors_of_many_tiles(spark, monkeypatch, few, bucket, row):
    """cells are shuffled and stored as packed numbers in tiles."""
    for name, value in (("FEW_WORDS", few), ("BUCKET_PAIRS", bucket), ("ROW_CELLS", row), ("HELD_PAIRS", 20), ("OVERSAMPLE", 30)):
        monkeypatch.setattr(S, name, value)
    docs = corpus(4) + [(93, ["a1", None, "a1", "b1"]), (93, ["a1", "a1"])]
    words = sorted(w for w, k in Counter(w for _, t in docs for w in t or [] if w).items() if k >= 3)
    vocabulary = spark.createDataFrame([(w,) for w in [*words, None]], "word string")
    counts = S.cooccurrences(frame(spark, docs), vocabulary, 3)
    assert (counts.grid > 2) == (few == 5)
    n = Counter()
    for _, t in docs:
        for i, w in enumerate(t or []):
            for c in t[max(0, i - 3):i]:
                if w in words and c in words:
                    n[tuple(sorted((w, c)))] += 2 if w == c else 1
    got = [(tuple(sorted((r["word"], r["context"]))), r["n"]) for r in counts.rows().collect()]
    assert len(got) == len(n) and dict(got) == n
    cells = slow_cells([[w or "" for w in t] for _, t in docs if t], set(words), 3)
    found = S.ppmi(counts)
    rows = found.collect()
    assert len(rows) == len(cells) and all(abs(cells[r["word"], r["context"]] - r["value"]) < 1e-12 for r in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" not in plan and "hashpartitioning(context" not in plan
    want, _ = slow_vectors(cells, words, 4)
    have = {r["word"]: r["vector"] for r in S.train_subspace(
        frame(spark, docs), dict(vectorSize=4, windowSize=3, maxIter=2), vocabulary=vocabulary).collect()}
    assert have.pop(None) == [0.0] * 4 and sorted(have) == words
    assert abs(cosines(np.array([have[w] for w in words])) - cosines(want)).max() < 1e-6


def test_training_leaves_vectors_and_words_only(spark):
    """the matrix and the blocks of the iterations are gone with their shuffles."""
    before = folders(spark)
    S.train_subspace(frame(spark, corpus(5)), dict(vectorSize=4, windowSize=3, minCount=3, maxIter=2))
    assert left_over(spark, before) == ["subspace-words", "vocabulary"]


def test_packed_cells():
    codes = np.array([0, 5, 1 << 40, (1 << 62) + 3])
    counts = np.array([1, 300, 1 << 33, 2])
    data = S.packed(codes, counts)
    assert all(np.array_equal(x, y) for x, y in zip(S.unpacked(data, 4), (codes, counts)))
    rng = np.random.default_rng(1)
    many = np.cumsum(rng.integers(1, 2000, 1 << 16))
    assert len(S.packed(many, rng.geometric(0.7, 1 << 16))) < 4 * len(many)  # a row of two words and a number had some 30


def test_inference_stores_documents_as_numbers(spark):
    """tokens are read in the call only; keys may repeat or be null, words may be unknown."""
    from quire.session import remove_stages, stage, stage_scope
    words = {"a": [1.0, 0.0], "b": [0.0, 2.0], "c": [1.0, 1.0]}
    model = S.DocumentModel(spark.createDataFrame([*words.items(), (None, [9.0, 9.0])], "word string, vector array<double>"), 2)
    rows = [("x", ["a", "b", None, "new"]), ("x", ["a"]), ("y", ["new", "newer"]), ("z", None), ("u", []), (None, ["a"]), ("v", ["c", "c", "b"])]
    with stage_scope(spark) as used:
        tokens = stage(spark.createDataFrame(rows, "k string, t array<string>"), "tokens")
    found = model.infer(tokens, "k", "t")
    remove_stages(spark, used)
    got = {r["k"]: r["vector"] for r in found.collect()}
    assert sorted(got, key=str) == sorted({k for k, _ in rows}, key=str) and found.count() == len(got)
    v = np.array([*words.values(), [9.0, 9.0]])
    for key, vector in got.items():
        n = Counter(w for k, t in rows if k == key and k for w in t or [])
        want = np.linalg.solve(v.T @ v + np.eye(2), v.T @ [*(math.log1p(n[w]) for w in words), 0.0])
        assert vector == pytest.approx(want.tolist(), abs=1e-12)


def test_ppmi_cells_keeps_counts_and_words_only(spark, tmp_path):
    """the documents' tokens and the counts' shuffles are gone when the rows are made."""
    from quire.plans.vector_queries import q_ppmi_cells
    docs = [(i, " ".join(t)) for i, t in corpus(6, 400) if t]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    before = folders(spark)
    found = q_ppmi_cells(spark, str(tmp_path))
    assert left_over(spark, before) == ["counts", "strip-totals", "strips"]
    words = {w for w, k in Counter(w for _, t in docs for w in t.split()).items() if k >= 25}
    cells = slow_cells([t.split() for _, t in docs], words, 5)
    rows = found.collect()
    assert len(rows) == len(cells) > 100 and all(abs(cells[r["word"], r["context"]] - r["value"]) < 1e-6 for r in rows)
