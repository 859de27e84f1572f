"""Rule ensemble: rules, scores and held-out accuracy."""

import math
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quire.llm import quality_model as M
from quire.llm.common import held_out, read_table

LABELS = "doc_id long, quality int"


def corpus(n=160):
    rng = random.Random(1)
    words = [a + b for a in "ba ke li mo nu".split() for b in "ra te ni so lu ka".split()]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.randint(20, 80))
        bad = i % 3 == 0
        text = " ".join(x + "###" for x in w) if bad else ". ".join(" ".join(w[k:k + 7]) for k in range(0, len(w), 7))
        docs.append((i, text))
        labels.append((i, int(not bad)))
    return docs, labels


def test_statistics():
    assert M.statistics(None) == M.statistics("") == M.statistics(" \n") == (0.0,) * len(M.STATS)
    s = dict(zip(M.STATS, M.statistics("Aa bb bb |\nAa bb bb |\n")))
    assert s["words"] == 8 and s["bare"] == 0.25 and s["repeat_lines"] == 0.5 and s["repeat_next"] == 0.25
    assert len(M.statistics("x " * 300_000)) == len(M.STATS)


def test_fold_is_crc32_of_the_key(spark):
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_scores_equal_the_rules(spark):
    docs, labels = corpus()
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    model = M.fit(d, lab, trees=6)
    assert model.rules and model.describe()
    truth = dict(labels)
    for r in M.score(d, model).collect():
        stats = dict(zip(M.STATS, M.statistics(r.text)))
        total = model.bias + sum(w for w, rule in model.rules
                                 if all((stats[s] <= t) if low else (stats[s] > t) for s, low, t in rule))
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9
        assert (r.score >= 0.3) == (truth[r.doc_id] == 1)


def test_labels_of_the_held_out_fold_have_no_influence(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    a, b = (M.fit(d, spark.createDataFrame(x, LABELS), trees=4) for x in (labels, other))
    assert (a.bias, a.rules) == (b.bias, b.rules)


def test_few_or_odd_labels(spark):
    docs, labels = corpus(30)
    d = spark.createDataFrame(docs + [(None, None), (3, docs[3][1])], "doc_id long, text string")
    none = spark.createDataFrame([], LABELS)
    assert all(r.score > 0.999 for r in M.score(d, M.fit(d, none)).collect())
    ones = spark.createDataFrame([(i, 1) for i, _ in docs] + [(None, 1), (4, None), (5, 7), (999, 0)], LABELS)
    assert all(r.score > 0.999 for r in M.score(d, M.fit(d, ones)).collect())
    zeros = spark.createDataFrame([(i, 0) for i, _ in docs], LABELS)
    model = M.fit(d, zeros)
    assert all(r.score < 0.001 for r in M.score(d, model).collect()) and M.filter_documents(d, model).count() == 0


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x", 1.0)], "doc_id long, text string, Score string, words double")
    model = M.RuleModel(0.0, [(1.0, [("words", True, 5.0)])])
    got = M.score(df, model)
    assert got.columns == ["doc_id", "text", "words", "score"]
    assert abs(got.first()["score"] - 1 / (1 + math.exp(-1))) < 1e-12
    assert M.filter_documents(df, model).columns == df.columns
    assert M.score(df.limit(0), model).collect() == []


def test_sample_is_bounded(spark):
    docs, labels = corpus(160)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    assert 10 <= M.sample(d, lab, "doc_id", "text", "quality", 40, 5).count() <= 70


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("driver tables absent")
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    scored = M.score(docs.select("doc_id", "text"), M.fit(docs, labels)).join(labels, "doc_id").toPandas()
    held = scored[[zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]]
    assert len(held) > 50 and ((held.score >= 0.3) == (held.quality == 1)).mean() > 0.97
