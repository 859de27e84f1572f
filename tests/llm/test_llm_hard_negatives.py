"""Hard negatives against brute force in whole numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow_mine(rows, positives=5, negatives=10, low=30, high=90, every=3):
    kept = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i not in kept or (y, v) < kept[i]:
            kept[i] = (y, v)
    data = {i: (y, [math.floor(256 * x) for x in v]) for i, (y, v) in kept.items()}
    out = []
    for a, (label, va) in data.items():
        if a % every:
            continue
        score = {i: sum(x * z for x, z in zip(va, v)) for i, (_, v) in data.items()}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and data[i][0] == label][:positives]:
            found = [i for i in order if data[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(found[:negatives], 1)]
    return sorted(out)


def table(seed=1, n=160, d=6, labels=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = rng.randrange(labels) if rng.random() < 0.6 else 0
        v = [rng.gauss(0.3 if j == y else 0.1, 0.2) for j in range(d)]
        rows.append((i, [round(x, 1) for x in v] if i % 4 else v, y))
    return rows


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 3 == 0, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"positives": 2, "negatives": 3, "low": 0, "high": 100}])
def test_mine_equals_brute_force(spark, options):
    rows = table()
    got = mined(spark, rows, **options)
    assert got == slow_mine(rows, **options) and len(got) > 100


def test_many_tiles(spark, monkeypatch):
    """Labels and rows over many tiles, anchors and rows in several blocks."""
    for name, value in (("TILE_ROWS", 16), ("LEAST_TILE_ROWS", 8), ("BLOCK_ANCHORS", 7), ("BLOCK_ROWS", 5)):
        monkeypatch.setattr(H, name, value)
    rows = table(seed=2)
    assert mined(spark, rows) == slow_mine(rows)


def test_odd_rows(spark):
    rows = table(n=30)
    rows += [(None, rows[0][1], 1), (100, None, 1), (102, [0.1, None], 0), (105, [float("nan")] * 6, 0),
             (108, [float("inf")] * 6, 1), (111, rows[2][1], None), (114, [], 0), (117, [0.5, 0.5], 1), (3, rows[3][1], rows[3][2]),
             (6, [0.2] * 6, 2), (120, rows[0][1], 0), (121, rows[0][1], 0), (123, [-1.0] * 6, 1), (126, [0.0] * 6, 77)]
    assert mined(spark, rows) == slow_mine(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = H.mine(empty, F.col("vec_id") % 3 == 0)
    assert got.count() == 0
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 1)]) == []  # no anchor


def test_clashing_columns(spark):
    rows = table(n=40)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], f"{SCHEMA}, `a.b` string, tile int, score int")
    got = sorted(map(tuple, H.mine(df, F.col("vec_id") % 3 == 0).collect()))
    assert got == slow_mine(rows)


def test_residue_scores_are_exact():
    rng = np.random.default_rng(1)
    for size, width in ((3, 5), (200, 64), (100_000, 64), (4_000_000, 200), (130, 1000)):
        a = np.floor(rng.normal(0, size, (9, width)))
        b = np.floor(rng.normal(0, size, (11, width)))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert H.scores(H.Block(a), H.Block(b)).tolist() == want


def test_residues_fit_float32():
    most = max(H.PRIMES) // 2
    assert H.WIDTH * most * most < 1 << 24
    r = H.residues(np.arange(-5000.0, 5000.0), 1021)
    assert abs(r).max() <= most and ((np.arange(-5000, 5000) - r) % 1021 == 0).all()
    full = np.full((1, H.WIDTH), float(most))
    assert H.scores(H.Block(full), H.Block(-full))[0, 0] == -H.WIDTH * most * most


def test_primes_follow_the_bound():
    assert H.primes_for(100) == (1021,) and len(H.primes_for(1e6)) == 3
    assert len(H.primes_for(H.NORM_LIMIT ** 2)) == len(H.PRIMES)
    with pytest.raises(ValueError):
        H.Block(np.full((1, 4), 1e30))
