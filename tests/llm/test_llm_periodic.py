"""Periodic runs against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import periodic as P


def slow_runs(w, exponent=4, min_length=6):
    n, found = len(w), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def slow_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def check(texts, **options):
    got = P.group_runs(texts, **options)
    for words, (runs, kept) in zip(texts, got):
        want = slow_runs(words, **options)
        assert sorted(runs) == want
        assert runs == sorted(runs, key=lambda r: (r[0], r[2]))
        assert kept == slow_collapsed(words, want)


def planted(rng, letters):
    """Pieces of random words, powers, and powers of powers."""
    out = []
    for _ in range(rng.randint(1, 6)):
        word = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            word = word * rng.randint(2, 5) + [rng.choice(letters)]
        out += (word * rng.randint(1, 9))[: rng.randint(1, 400)]
    return out


@pytest.mark.parametrize("letters", [[b"a"], [b"a", b"b"], [b"a", b"b", b"c"], [b"%d" % i for i in range(40)]])
def test_runs_equal_brute_force(letters):
    rng = random.Random(len(letters))
    for _ in range(25):
        check([planted(rng, letters) for _ in range(rng.randint(1, 8))])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=40), min_size=1, max_size=4))
def test_runs_of_any_words(texts):
    check(texts)


@pytest.mark.parametrize("options", [{"exponent": 2, "min_length": 2}, {"exponent": 3, "min_length": 9}])
def test_other_exponents(options):
    rng = random.Random(3)
    for _ in range(15):
        check([planted(rng, [b"a", b"b", b"c"]) for _ in range(3)], **options)


def test_word_at_every_second_place():
    """A word on the whole grid, but no run: as many questions as grid places."""
    rng = random.Random(1)
    check([[b"x" if i % 2 else b"%d" % rng.randint(0, 5) for i in range(3000)]])


def test_extensions_in_both_directions():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 5):
        text = rng.integers(0, letters, 300)
        text[100:160] = text[20:80]
        text = np.concatenate([[-1], text[:200], [-2], text[200:], [-3]])
        levels = P.recompress(text)
        assert not ((levels[-1].sym[1:] >= 0) & (levels[-1].sym[:-1] >= 0)).any()
        i, j = (x.ravel() for x in np.meshgrid(np.arange(len(text)), np.arange(len(text))))
        i, j = i[i != j], j[i != j]

        def slow(t):
            m = np.zeros((len(t) + 1, len(t) + 1), dtype=int)
            for a in range(len(t) - 1, -1, -1):
                m[a, :-1] = np.where(t[a] == t, m[a + 1, 1:] + 1, 0)
            return m[i, j]

        assert (P.extensions(levels, i, j) == slow(text)).all()
        assert (P.extensions([v.backwards() for v in levels], i, j) == slow(text[::-1])).all()


def test_long_texts():
    check([[b"a"] * 5000, [b"a", b"b"] * 2500, [b"%d" % i for i in range(4000)]])
    runs, kept = P.group_runs([[b"a"] * 300_000])[0]
    assert runs == [(0, 300_000, 1)] and kept == [b"a"]


def test_rows(spark):
    rows = [(1, "a b " * 10), (2, None), (3, ""), (4, " \n\t\x0b"), (1, "a b " * 10), (None, "x x x x x x"),
            (5, "Ä\x85 Ä\x85 Ä\x85 Ä\x85 Ä\x85 Ä\x85"), (6, "x x x x x")]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], ["doc_id", "text", "runs", "x.y"])
    got = sorted(map(tuple, P.find_runs(docs).collect()), key=str)
    want = []
    for k, t in rows:
        w = (t or "").encode().split()
        runs = slow_runs(w)
        want.append((k, len(w), runs, b" ".join(slow_collapsed(w, runs)).decode()))
    assert [(a, b, [tuple(r) for r in c], d) for a, b, c, d in got] == sorted(want, key=str)
    empty = P.find_runs(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_dotted_names(spark):
    docs = spark.createDataFrame([(1, "b b b b b b")], ["a.b", "c.d"])
    got = P.find_runs(docs, "a.b", "c.d").collect()
    assert got[0][0] == 1 and got[0]["runs"][0]["length"] == 6


def test_bad_exponent(spark):
    with pytest.raises(ValueError):
        P.find_runs(spark.createDataFrame([(1, "a")], ["doc_id", "text"]), exponent=1)
