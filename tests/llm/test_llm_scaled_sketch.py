"""Threshold-scaled sketches against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import scaled_sketch as S

P = (1 << 31) - 1
A, B = (1103515245, 12345679, 1664525, 1013904223, 69069), 40692


def slow_shingles(text):
    w = ["".join(c.lower() if c.isascii() else c for c in x)
         for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    size = min(5, len(w))
    out = set()
    for i in range(len(w) - size + 1 if w else 0):
        one = two = size * B
        for k in range(size):
            d = hashlib.md5(w[i + k].encode()).digest()
            one += int.from_bytes(d[8:], "little") * A[k]
            two += int.from_bytes(d[:8], "little") * A[k]
        out.add((one % P) << 17 | (two % P) % (1 << 17))
    return sorted(out)


def slow_sketch(text):
    h = slow_shingles(text)
    return [x for i, x in enumerate(h) if x < (P // 8) << 17 or i < 16]


def slow_like(a, b):
    if not a or not b:
        return float(a == b)
    full = [float("inf") if len(x) < 16 else max(((P // 8) << 17) - 1, x[-1]) for x in (a, b)]
    a, b = ({h for h in x if h <= min(full)} for x in (a, b))
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def texts(seed=1, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = [" ".join(rng.choices(words, k=rng.choice([1, 3, 5, 8, 19, 20, 21, 60, 400, 2000]))) for _ in range(n)]
    return out + ["", None, " \t\n", "Ä Ö\x0bÜ x Y Z", "a", out[3], out[3].upper(), out[9] + " tail", "é" * 400]


def test_sketch_equals_plain_version():
    hashes = S.WordHash()
    for t in texts():
        assert S.sketch(t, hashes).tolist() == slow_sketch(t)
        assert S.hex_of(S.sketch(t, hashes)) == "".join(f"{h:012x}" for h in slow_sketch(t))


def test_likeness_equals_plain_version():
    hashes = S.WordHash()
    all_of = [S.sketch(t, hashes) for t in texts()]
    for a in all_of:
        for b in all_of:
            assert S.likeness(a, b) == slow_like(a.tolist(), b.tolist()) == S.likeness(b, a)
        assert S.likeness(a, a) == 1.0


def test_sketches_merge():
    """The merge of sketches is the sketch of the union, in any order."""
    rng = random.Random(2)
    hashes = S.WordHash()
    for _ in range(40):
        some = rng.sample(texts(), 3)
        union = sorted({h for t in some for h in slow_shingles(t)})
        want = [x for i, x in enumerate(union) if x < S.FRACTION or i < 16]
        parts = [S.sketch(t, hashes) for t in some]
        assert S.merged(parts).tolist() == want
        assert S.merged([S.merged(parts[:2]), parts[2]]).tolist() == want


def test_containment_estimate_of_unequal_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    hashes = S.WordHash()
    errors = []
    for _ in range(30):
        long = rng.choices(words, k=20_000)
        share = rng.random()
        cut = int(600 * share)
        short = long[100:100 + cut] + rng.choices(words, k=600 - cut)
        a, b = set(slow_shingles(" ".join(short))), set(slow_shingles(" ".join(long)))
        got = S.likeness(S.sketch(" ".join(short), hashes), S.sketch(" ".join(long), hashes))
        errors.append(abs(got - len(a & b) / len(a)))
    assert np.mean(errors) < 0.06


def test_retained_share():
    hashes = S.WordHash()
    t = " ".join(str(i) for i in range(80_000))
    assert abs(len(S.sketch(t, hashes)) / 80_000 - 1 / S.SCALE) < 0.01


def test_columns(spark):
    rows = [(i, t, "z") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, ["doc_id", "text", "x.y"])
    df = df.withColumn("sketch", S.fingerprint(df))
    assert "x.y" in df.columns
    got = {r.doc_id: r.sketch for r in df.collect()}
    assert got == {i: slow_sketch(t) for i, t, _ in rows}
    pairs = df.select(F.col("doc_id").alias("i"), F.col("sketch").alias("a")).crossJoin(
        df.select(F.col("doc_id").alias("j"), F.col("sketch").alias("b")))
    for r in pairs.where("i % 3 = 0").select("i", "j", S.containment(F.col("a"), F.col("b")).alias("c")).collect():
        assert r.c == slow_like(got[r.i], got[r.j])
    groups = df.select(F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 7).alias("grp"), "sketch")
    for r in S.merge(groups, "grp").collect():
        union = sorted({h for i, t, _ in rows if (i % 7 or None) == r.grp for h in slow_shingles(t)})
        assert r.sketch == [x for i, x in enumerate(union) if x < S.FRACTION or i < 16]


def slow_next(rows):
    """Rows of distinct (key, text) in the order of against_next."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (k, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        e = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        a, b, c = slow_sketch(t), slow_sketch(e), slow_sketch(n)
        text = lambda s: "".join(f"{h:012x}" for h in s)
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), text(a), text(b), slow_like(a, b), slow_like(a, c), len(a)))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_rows", [1, 3, 10, 20_000])
def test_against_next(spark, monkeypatch, range_rows):
    monkeypatch.setattr(S, "RANGE_ROWS", range_rows)
    rng = random.Random(range_rows)
    rows = [(k, t) for k, t in zip(rng.sample(range(-500, 2 ** 40), 80), texts(range_rows))] + [(None, "Null key of ours")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, `a.b` int").repartition(3)
    assert sorted(map(tuple, S.against_next(df).collect()), key=str) == slow_next(rows)


def test_repeated_keys_and_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "RANGE_ROWS", 1)
    rows = [(1, "a b c d e f")] * 5 + [(2, "q")] + [(None, None)] * 3
    got = S.against_next(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got.collect()) == \
        sorted((k is None, k or 0, len(t or "")) for k, t in rows)


def test_one_row_and_none(spark):
    one = S.against_next(spark.createDataFrame([(7, "abcd")], "doc_id int, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    none = S.against_next(spark.createDataFrame([], "doc_id int, text string"))
    assert none.count() == 0 and none.columns[0] == "doc_id" and none.schema[0].dataType.simpleString() == "int"
