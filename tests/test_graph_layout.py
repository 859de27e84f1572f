"""Landmark layout: distances, scaling and triangulation against plain versions."""

import heapq

import numpy as np
from pyspark.sql import functions as F

from quire.operators import graph_layout as G
from quire.operators import layout as L


def _clustered(n_clusters=12, size=25, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n_clusters, dim))
    return np.concatenate([c + 0.3 * rng.standard_normal((size, dim)) for c in centres])


def _frame(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "doc_id long, vector array<double>")


def _paths(edges, source):
    links = {}
    for a, b, w in edges:
        links.setdefault(a, []).append((b, w))
    best, heap = {source: 0}, [(0, source)]
    while heap:
        d, x = heapq.heappop(heap)
        if d > best[x]:
            continue
        for y, w in links.get(x, ()):
            if d + w < best.get(y, float("inf")):
                best[y] = d + w
                heapq.heappush(heap, (d + w, y))
    return best


def test_landmark_distances_are_shortest_paths(spark):
    nodes = G.distinct_vectors(_frame(spark, _clustered()))
    edges = G.neighbor_graph(nodes, 5)
    listed = [tuple(r) for r in edges.select("src", "dst", "length").collect()]
    assert {(b, a, w) for a, b, w in listed} == set(listed)
    marks = G.choose_landmarks(nodes, 6)
    got = {r["node"]: r for r in G.landmark_distances(edges, marks).collect()}
    for i, m in enumerate(marks):
        assert {n: r[f"d{i}"] for n, r in got.items() if r[f"d{i}"] is not None} == _paths(listed, m)


def test_scaling_recovers_points_of_a_plane():
    rng = np.random.default_rng(0)
    marks, points = rng.standard_normal((8, 2)), rng.standard_normal((30, 2))
    means, weights = G.landmark_axes(((marks[:, None] - marks[None]) ** 2).sum(-1))
    got = np.array([weights @ (means - ((marks - p) ** 2).sum(-1)) / 2 for p in points])
    want = ((points[:, None] - points[None]) ** 2).sum(-1)
    assert np.allclose(((got[:, None] - got[None]) ** 2).sum(-1), want)


def _kept(frame, m, k=10):
    rows = {r["doc_id"]: (r["x"], r["y"]) for r in frame.collect()}
    xy = np.array([rows[i] for i in range(len(m))])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -9)
    far = ((xy[:, None] - xy[None]) ** 2).sum(-1)
    np.fill_diagonal(far, np.inf)
    a, b = np.argsort(-sims, axis=1)[:, :k], np.argsort(far, axis=1)[:, :k]
    return np.mean([len(set(p) & set(q)) / k for p, q in zip(a, b)])


def test_more_neighbours_kept_than_by_projections(spark):
    m = _clustered()
    df = _frame(spark, m)
    ours = _kept(G.landmark_layout(df), m)
    assert ours > _kept(L.random_projection(df, m.shape[1], 7), m)
    assert ours > _kept(L.pca_projection(df), m)


def test_layout_edge_cases(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [0.0, 1.0]), (6, [float("nan"), 1.0]),
            (7, [None, 1.0]), (8, [-1.0, 0.5]), (8, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "doc_id int, vector array<double>").withColumn("placed", F.lit(1))
    got = sorted((tuple(r) for r in G.landmark_layout(df, k=2, landmarks=3).collect()), key=repr)
    assert len(got) == len(rows)
    at = {i: (x, y) for i, x, y in got}
    assert at[1] == at[2] and got.count((8, *at[8])) == 2
    assert all(at[i] == (None, None) for i in (3, 4, 6, 7)) and None not in at[1] + at[5] + at[8]
    assert G.landmark_layout(df.where("doc_id = 3")).first()["x"] is None
    assert G.landmark_layout(df.limit(0)).collect() == []
    alone = G.landmark_layout(df.where("doc_id = 1")).first()
    assert (alone["x"], alone["y"]) == (0.0, 0.0)


def test_unreached_nodes_have_places(spark):
    # two groups whose nearest neighbours never cross
    rows = [(i, [1.0, 0.01 * i, 0.0]) for i in range(6)] + [(10 + i, [0.0, 0.01 * i, 1.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id int, vector array<double>")
    got = {r["doc_id"]: (r["x"], r["y"]) for r in G.landmark_layout(df, k=2, landmarks=1, smoothing=0).collect()}
    assert len(got) == 12 and all(None not in p for p in got.values())
