"""Benchmark decontamination against a plain scan."""

import random
import re

import pytest

from quire.llm import decontaminate as D

BENCH = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_scan(text, items, n=10):
    w, hit, found = slow_words(text), set(), set()
    for item, t in items:
        v = slow_words(t)
        size = min(n, len(v))
        windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if size else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def sample(rng):
    items = [(i, " ".join(rng.choices("ab cd ef É9 gh ij".split(), k=k)))
             for i, k in enumerate([1, 2, 3, 9, 10, 11, 12, 25, 40, 40])]
    items += [(100, None), (101, ""), (102, "--- !"), (None, "null item of its own words"), (7, items[7][1])]
    docs = []
    for d in range(60):
        w = rng.choices("ab cd ef É9 gh zz q,q".split(), k=rng.randint(0, 40))
        if d % 3 == 0:
            w += items[rng.randrange(10)][1].upper().split()
        docs.append((d, " ; ".join(w)))
    return items, docs + [(900, None), (901, ""), (902, "Null ITEM of its-own words!"), (902, "Null ITEM of its-own words!")]


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 150])
def test_scan_equals_plain_scan(spark, block):
    items, docs = sample(random.Random(5))
    got = D.scan(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, BENCH),
                 block_bytes=block).collect()
    assert len(got) == len(docs)
    want = {d: slow_scan(t, items) for d, t in docs}
    for r in got:
        assert (r.n_words, r.n_hit, list(r["items"])) == want[r.doc_id], r


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two three", "kept", 5)], "doc_id long, text string, ITEMS string, spans int")
    bench = spark.createDataFrame([(1, "two")], BENCH)
    got = D.scan(docs, bench)
    assert got.columns == ["doc_id", "text", "n_words", "spans", "n_hit", "items"] and got.first().n_hit == 1
    assert D.clean(docs, bench).columns == docs.columns and D.clean(docs, bench).count() == 0
    none = spark.createDataFrame([], BENCH)
    assert D.clean(docs, none).collect() == docs.collect()
    assert D.scan(docs.limit(0), bench).collect() == []


def test_spans_are_cut_until_clean(spark):
    docs = spark.createDataFrame([(1, "Keep a b, c d. Keep too"), (2, "a a b c d b c d tail"), (3, None)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "A b c d")], BENCH)
    got = {r.doc_id: r.text for r in D.clean(docs, bench, mode="spans").collect()}
    assert got == {1: "Keep . Keep too", 2: " tail", 3: None}
    assert {r.doc_id for r in D.clean(docs, bench).collect()} == {3}
    with pytest.raises(ValueError):
        D.clean(docs, bench, mode="other")


def test_spans_are_cut_across_blocks(spark):
    """Cutting the one item completes the other, which lies in another block."""
    docs = spark.createDataFrame([(1, "x p1 q1 p2 y"), (2, "q2 p1 q1 p2 q3 z")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "p1 q1 p2"), (2, "q2 q3"), (3, "unrelated words")], BENCH)
    for size in (8, 12, D.BLOCK_BYTES):
        got = D.clean(docs, bench, mode="spans", block_bytes=size)
        assert {r.doc_id: r.text.split() for r in got.collect()} == {1: ["x", "y"], 2: ["z"]}


def test_colliding_hashes_are_verified(monkeypatch):
    import numpy as np
    monkeypatch.setattr(D.WindowSet, "rolled", staticmethod(
        lambda cols: np.zeros(len(np.asarray(cols[0])), dtype=np.uint64)))
    items, docs = sample(random.Random(6))
    index = D.WindowSet([("" if i is None else str(i), t) for i, t in items], 10)
    for _, t in docs:
        n, hits = index.scan(t)
        assert (n, sorted({h[2] for h in hits})) == (slow_scan(t, items)[0], slow_scan(t, items)[2])


def test_very_long_text():
    index = D.WindowSet([("1", "needle " * 10)], 10)
    n, hits = index.scan("hay " * 400_000 + "needle " * 11)
    assert n == 400_011 and D.runs(hits) == [(400_000, 400_011, "1")]


def test_a_full_block_takes_the_stated_memory():
    import tracemalloc
    rng = random.Random(6)
    vocabulary = [f"{rng.randrange(16 ** 5):05x}" for _ in range(30_000)]
    n = D.BLOCK_BYTES // 6
    items = [(str(i), " ".join(rng.choices(vocabulary, k=n // 300))) for i in range(300)]
    tracemalloc.start()
    try:
        index = D.WindowSet(items, 10)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    print(f"{held / n:.0f} bytes a word held, {peak / n:.0f} at most")
    assert held < 60 * n and peak < 120 * n
    assert {i for _, _, i in index.scan(items[7][1])[1]} == {"7"}
