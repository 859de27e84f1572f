"""Random indexing and document means against plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quire.operators import dealt, training


def corpus(n=50, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(40)]
    return [(i, [rng.choice(words[:rng.randint(1, 40)]) for _ in range(rng.randint(0, 30))]) for i in range(n)] + [
        (90, None), (91, []), (92, ["w1é", None, "w2é", "w1é"])]


def sign(word, d):
    block, bit = divmod(d, 128)
    return (int(hashlib.md5(f"{block}/{word}".encode()).hexdigest()[bit // 4], 16) >> bit % 4 & 1) * 2 - 1


def slow_sums(docs, size, window):
    out = defaultdict(lambda: [0] * size)
    for t in docs:
        for i, w in enumerate(t or []):
            for c in (t[j] for j in range(max(0, i - window), min(len(t), i + window + 1)) if j != i):
                if c is not None and w is not None:
                    out[w] = [a + sign(c, d) for d, a in enumerate(out[w])]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


@pytest.mark.parametrize("step, held", [(1 << 15, 150_000), (7, 5)])  # one step; steps inside documents, words let go
def test_sums_of_steps_equal_plain_loops(step, held, monkeypatch):
    monkeypatch.setattr(training, "STEP_WORDS", step)
    docs = [t for _, t in corpus()]
    got = defaultdict(lambda: np.zeros(130, int))
    sums, column = training.ContextSums(130, 4), pa.array(docs, pa.list_(pa.string()))
    flat, doc = dealt.flat_words(column)
    lengths = np.bincount(doc, minlength=len(docs))
    ends = np.cumsum(lengths)
    starts, ends = (ends - lengths)[doc], ends[doc]
    rows = []
    for a in range(0, len(doc), step):
        sums.add(flat, starts, ends, a, min(a + step, len(doc)))
        if len(sums.at) >= held:
            rows += sums.rows()
            sums.clear()
    for batch in [*rows, *sums.rows()]:
        for r in batch.to_pylist():
            got[r["word"]] += np.array(r["small"] or r["large"])
    want = slow_sums(docs, 130, 4)
    assert {w: v.tolist() for w, v in got.items() if v.any()} == {w: v for w, v in want.items() if any(v)}


def test_training_shuffles_sums_and_not_pairs(spark, capsys):
    """The plan counts no (word, context) pairs: only sums, one row a task and word, move."""
    docs = corpus()
    model = training.train_distributed(frame(spark, docs), {"vectorSize": 6, "windowSize": 3, "minCount": 2})
    model.explain()
    assert "context" not in capsys.readouterr().out
    times = Counter(w for _, t in docs for w in t or [] if w is not None)
    want = slow_sums([t for _, t in docs], 6, 3)
    assert {r["word"]: r["vector"] for r in model.collect() if r["word"] is not None} == {
        w: list(want[w]) for w, k in times.items() if k >= 2}


def test_mean_vectors_of_repeated_and_null_keys_in_many_batches(spark):
    rows = corpus() + [(7, ["w1é", "none"]), (7, ["w2é"]), (None, ["w1é"] * 3), (None, ["w2é"]), (93, ["none"])]
    model = {"w1é": [3.0, 4.0], "w2é": [0.0, -2.0], "w3é": [0.0, 0.0]}
    wv = spark.createDataFrame([*model.items(), ("w2é", [5.0, 0.0])], "word string, vector array<double>")
    unit = {"w1é": [(0.6, 0.8)], "w2é": [(0.0, -1.0), (1.0, 0.0)], "w3é": [(0.0, 0.0)]}
    known = defaultdict(list)
    for key, tokens in rows:
        known[key] += [u for w in tokens or [] for u in unit.get(w, [])]
    for size in ("10000", "2"):
        before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = training.mean_vectors(wv, frame(spark, rows), size=2).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k in known)
        for r in got:
            have = known[r["doc_id"]]
            assert r["vector"] == pytest.approx(np.mean(have, axis=0).tolist() if have else [0.0, 0.0], abs=1e-12)


def test_a_block_holds_only_rows_of_its_own_words(spark):
    docs = frame(spark, [(i, [f"a{i}", "all"]) for i in range(30)])
    lookup = spark.createDataFrame([(f"a{i}", i) for i in range(60)] + [("all", 99)], "word string, value long")
    rows = dealt.deal(docs, lookup, "doc_id", "tokens").collect()
    per_block = defaultdict(lambda: (set(), set()))
    for r in rows:
        mine, asked = per_block[r["block"]]
        asked.update(r["tokens"]) if r["side"] else mine.add(r["word"])
    assert len(per_block) > 1 and all(mine == asked for mine, asked in per_block.values())
