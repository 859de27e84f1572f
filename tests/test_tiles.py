import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from quire.operators import tiles


def _brute(points, tile_size, max_depth):
    xs = [p[1] for p in points]
    ys = [p[2] for p in points]
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    remaining = sorted(points, key=lambda p: (p[3], p[0]))
    out = {}
    for z in range(max_depth + 1):
        n = 1 << z
        def idx(v, lo, hi):
            return min(max(math.floor((v - lo) / ((hi - lo) or 1.0) * n), 0), n - 1)
        counts = defaultdict(int)
        nxt = []
        for p in remaining:
            t = (idx(p[1], x0, x1), idx(p[2], y0, y1))
            if z == max_depth or counts[t] < tile_size:
                counts[t] += 1
                out[p[0]] = (z, *t)
            else:
                nxt.append(p)
        remaining = nxt
        if not remaining:
            break
    return out


def test_quadtree_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    n = 700
    xy = rng.standard_normal((n, 2))
    xy[:300] = xy[:300] * 0.01        # a dense cluster: one hot tile per level
    order = rng.permutation(n)
    pts = [(int(i), float(xy[i, 0]), float(xy[i, 1]), int(order[i])) for i in range(n)]
    df = spark.createDataFrame(pts, "doc_id long, x double, y double, o long").repartition(5)
    got = tiles.quadtree_tiles(df, F.col("o"), tile_size=20)
    got = {r["doc_id"]: (r["z"], r["tx"], r["ty"]) for r in got.collect()}
    assert got == _brute(pts, 20, 30)


def test_rank_within_groups(spark):
    rows = [(g, v) for g in range(3) for v in range(50)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(7)
    r = tiles.rank_within(df, ["g"], [F.col("v").desc()])
    assert all(row["_rank"] == 49 - row["v"] for row in r.collect())


def test_points_in_one_place_are_paged(spark):
    pts = [(i, 1.0, 2.0, i) for i in range(25)] + [(100, 0.0, 0.0, 100), (101, None, 1.0, 101), (102, float("nan"), 1.0, 1)]
    df = spark.createDataFrame(pts, "doc_id long, x double, y double, o long")
    rows = tiles.quadtree_tiles(df, F.col("o"), tile_size=10).collect()
    assert len(rows) == 26                       # points without coordinates are in no tile
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["z"], r["tx"], r["ty"], r["page"]] += 1
    assert max(sizes.values()) <= 10 and {r["page"] for r in rows} == {0, 1}


def test_empty_input_has_no_tiles(spark):
    df = spark.createDataFrame([], "doc_id long, x double, y double, o long")
    out = tiles.quadtree_tiles(df, F.col("o"))
    assert out.collect() == [] and {"z", "tx", "ty", "page"} <= set(out.columns)


def test_one_file_a_page(spark, tmp_path):
    from quire.sources import sinks
    rows = [(i, 1, i % 2, i % 3, p) for p in range(2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, z int, tx int, ty int, page int").repartition(7)
    sinks.write_tiles(df, str(tmp_path / "tiles"))
    assert len(list((tmp_path / "tiles").rglob("*.parquet"))) == 2 * 3 * 2
    assert spark.read.parquet(str(tmp_path / "tiles")).count() == 120
