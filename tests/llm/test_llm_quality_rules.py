"""Quality rules against a plain computation."""

import math
import random
import re
from collections import Counter

import hashlib
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import quality_rules as Q

LABELS = "doc_id long, quality int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def slow_stats(text):
    text = text or ""
    w = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    wins = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) for k in range(3) if wins[tuple(w[i:i + 3])] > 1}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def slow_grams(text):
    h = [int.from_bytes(hashlib.md5(x.encode()).digest()[8:], "little") % 1_000_003 for x in WORDS.findall(text or "")]
    return [x % 65536 for x in h] + [(a * 31337 + b * 7) % 1_000_003 % 65536 for a, b in zip(h, h[1:])]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    good, bad = "red green blue cyan plum of the and".split(), "|| ### the and $$ buy now".split()
    docs = [(i, " ".join(rng.choices(bad if i % 4 == 0 else good, k=rng.randint(60, 200)))) for i in range(n)]
    docs += [(200, None), (201, ""), (202, " \n\t"), (203, "a b c " * 40), (204, "x\ny\nx\n\n \nx"), (5, docs[5][1]),
             (205, "Ä\x0bÖ\x0cü É" * 30), (None, docs[1][1])]
    labels = [(i, int(i % 4 != 0)) for i in range(0, n, 2)] + [(3, 1), (3, 0), (None, 1), (999, 1), (7, None)]
    return docs, labels


def test_base_statistics():
    for _, t in corpus()[0]:
        raw = (t or "").encode()
        assert Q.base_stats(t or "", raw, raw.split()) == slow_stats(t), t


def test_repeated_words_with_many_distinct(monkeypatch):
    words = [str(i).encode() for i in range(3000)] * 2 + [b"q"]
    assert Q.repeated_words(words) == 6000


def test_packed_buckets_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 70_000):
        grams = rng.integers(0, Q.BUCKETS, n)
        assert np.array_equal(Q.unpacked(Q.packed(grams)), np.sort(grams))


def slow_fold(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16) % 5 == 0


def slow_verdicts(docs, labels):
    """One row per document from the description: statistics, score, verdict."""
    good = {i for i, q in labels if q == 1 and i is not None}
    raw, target = Counter(), Counter()
    for i, t in docs:
        raw.update(slow_grams(t))
        if i in good and not slow_fold(i):
            target.update(slow_grams(t))
    n = sum(target.values())
    prior, scale = 2 * n / 65536, n / max(1, sum(raw.values()))
    ratio = {b: round(1e6 * math.log((target[b] + prior) / (raw[b] * scale + prior))) if n else 0 for b in raw}
    out, fold = [], []
    for i, t in docs:
        s, g = slow_stats(t), slow_grams(t)
        llr = sum(ratio[b] for b in g)
        out.append((i, *s, llr, len(g)))
        if i in good and slow_fold(i) and not s[-1] and n:
            fold.append(llr / (1000 * len(g)) // 1)
    fold.sort()
    at = lambda percent: fold[-(-percent * len(fold) // 100) - 1]
    least = 2 * at(1) - at(50) if fold else -math.inf
    return [(*r[:-1], not r[6] and (r[7] >= 1000 * least * r[8])) for r in out]


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_verdicts_equal_plain_computation(spark):
    docs, labels = corpus()
    d, lab = frames(spark, docs, labels)
    got = Q.score(d, lab)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "llr_micro", "kept"]
    assert Counter(map(tuple, got.collect())) == Counter(slow_verdicts(docs, labels))
    kept = {r.doc_id for r in Q.filter_documents(d, lab).collect()}
    assert kept and not any(i is not None and i < 60 and i % 4 == 0 for i in kept)


def test_verdicts_do_not_depend_on_the_number_of_rows(spark):
    """The same rows ten times over: the same ratios, threshold and verdicts."""
    docs, labels = corpus(3)
    docs = [(i, t) for i, t in docs if i is not None]
    once = {(r.doc_id, r.n_words, r.llr_micro, r.kept) for r in Q.score(*frames(spark, docs, labels)).collect()}
    many = Q.score(*frames(spark, docs * 10, labels)).collect()
    assert {(r.doc_id, r.n_words, r.llr_micro, r.kept) for r in many} == once and len(many) == 10 * len(docs)
    assert {k for *_, k in once} == {True, False}


@pytest.mark.parametrize("share", [2, 8])
def test_junk_is_rejected_at_any_size(spark, share):
    """Texts of another vocabulary than the trusted ones, in corpora of two sizes."""
    docs, labels = corpus(4, 100 * share)
    verdicts = {r.doc_id: r for r in Q.score(*frames(spark, docs, labels)).collect()}
    clean = [i for i in range(100 * share) if i % 4 and not verdicts[i].base_failed]
    assert not any(verdicts[i].kept for i in range(0, 100 * share, 4))
    assert sum(verdicts[i].kept for i in clean) >= 0.95 * len(clean)


def test_quantiles_of_a_histogram():
    rng = random.Random(1)
    for _ in range(50):
        values = [rng.randint(-5, 5) for _ in range(rng.randint(1, 300))]
        for percent in (1, 10, 50, 100):
            want = sorted(values)[-(-percent * len(values) // 100) - 1]
            assert Q.quantile(list(Counter(values).items()), percent) == want


def test_no_labels_empty_tables_and_clashes(spark):
    docs = spark.createDataFrame([(1, "w" + " w1 w2 w3 w4 w5" * 12, "x", 3, 4, 5)],
                                 "doc_id long, text string, Kept string, n_words int, `a.b` int, grams int")
    none = spark.createDataFrame([], LABELS)
    found = Q.measured(docs, "doc_id", "text", keep_rows=True)
    model = Q.fit(found, none)
    assert not model.ratios.any() and model.threshold is None
    assert Q.score(docs, none).first()[1:] == (61, 121, 0, 0, 60, True, 0, False)
    assert Q.filter_documents(docs, none).columns == docs.columns
    varied = docs.withColumn("text", F.lit(" ".join(f"w{i}" for i in range(80))))
    assert Q.filter_documents(varied, none).first() == varied.first()
    empty = docs.limit(0)
    assert Q.filter_documents(empty, none).collect() == [] and Q.score(empty, none).collect() == []
    only_fold = next(i for i in range(100) if slow_fold(i))
    one = spark.createDataFrame([(only_fold, varied.first().text)], "doc_id long, text string")
    assert Q.score(one, spark.createDataFrame([(only_fold, 1)], LABELS)).first().kept


def test_counts_ignore_partitioning(spark):
    docs, labels = corpus(2)
    d, lab = frames(spark, docs, labels)
    a, b = (Q.fit(Q.measured(x, "doc_id", "text", keep_rows=False), lab) for x in (d.repartition(7), d.coalesce(1)))
    assert np.array_equal(a.ratios, b.ratios) and a.threshold == b.threshold
