"""A 2-D layout that keeps neighbours (VEC-7): landmark distances over the
nearest-neighbour graph, then triangulation.

1. Equal vectors are one node. Each node is linked with its ``k`` most similar
   nodes (``knn``, exact or by cell), in both directions; a link is as long as the
   chord between the unit vectors, in whole millionths, so that lengths of paths
   are exact sums.
2. Shortest paths from all landmarks at once, in rounds: a node whose distances
   fell in the last round offers them to its neighbours, and a node takes the least
   offer for each landmark. A node is one row with a column for each landmark, so a
   round is one join and one aggregation with a partial minimum before its shuffle.
   It ends with the round that changes nothing.
3. Classical scaling of the landmarks alone: their squared distances, doubly
   centred, give two axes. Only this ``landmarks`` x ``landmarks`` matrix is on the
   driver, whatever the number of documents.
4. Each node's place is a linear function of its squared distances (triangulation):
   a Column expression without a shuffle.
5. ``smoothing`` rounds move a node half way to the mean of its neighbours.

A node that no path joins to a landmark counts as twice the greatest distance found
away from it. Null vectors, vectors with a null or non-finite component and zero
vectors have null coordinates; repeated rows each keep theirs; an empty table gives
no rows. Only the key and the vector column are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..session import remove_stages, stage, stage_scope
from .knn import top_k_neighbors
from .layout import shuffle_key

NEIGHBOURS = 10
LANDMARKS = 32
SMOOTHING = 4
UNIT = 1_000_000  # of link lengths


def _rows(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """``(key, vector, placed)``: every row, and whether its vector has a direction."""
    rows = vectors.select(F.col(key), F.col(vec).cast("array<double>").alias("vector"))
    size = V.norm("vector")
    return rows.withColumn("placed", F.coalesce((size > 0) & (size < F.lit(float("inf"))), F.lit(False)))


def distinct_vectors(vectors: DataFrame, key: str = "doc_id", vec: str = "vector") -> DataFrame:
    """``(node, vector)``: the vectors that have a direction, each under its least key."""
    return (_rows(vectors, key, vec).where("placed").groupBy("vector").agg(F.min(key).alias("node"))
            .select("node", "vector"))


def neighbor_graph(nodes: DataFrame, k: int = NEIGHBOURS, **search) -> DataFrame:
    """``(src, dst, length)``: the links between a node and its ``k`` nearest, each
    in both directions. ``search`` are options of ``knn.top_k_neighbors``."""
    near = top_k_neighbors(nodes, nodes, k, "node", "vector", **search)
    chord = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("sim")))
    links = near.select("qid", "cid", F.round(chord * UNIT).cast("long").alias("length"))
    both = links.toDF("src", "dst", "length").unionByName(links.toDF("dst", "src", "length"))
    return both.groupBy("src", "dst").agg(F.min("length").alias("length"))


def choose_landmarks(nodes: DataFrame, n: int = LANDMARKS) -> list:
    """``n`` nodes in the order of a seeded hash."""
    return [r["node"] for r in nodes.select("node").orderBy(shuffle_key("node"), "node").limit(n).collect()]


def landmark_distances(edges: DataFrame, landmarks: list) -> DataFrame:
    """``(node, d0, d1, ...)``: the length of the shortest path to each landmark,
    null where there is none. Nodes that no landmark reaches have no row."""
    spark = edges.sparkSession
    names = [f"d{i}" for i in range(len(landmarks))]
    schema = T.StructType([T.StructField("node", edges.schema["src"].dataType),
                           *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("changed", T.BooleanType())])
    state = spark.createDataFrame(
        [(mark, *[0 if i == j else None for j in range(len(landmarks))], True) for i, mark in enumerate(landmarks)], schema)
    written: list[str] = []
    while True:
        moved = state.where("changed").withColumnRenamed("node", "src")
        offers = (moved.join(edges, "src").groupBy(F.col("dst").alias("node"))
                  .agg(*[F.min(F.col(n) + F.col("length")).alias(f"o{n}") for n in names]))
        better = [F.coalesce(F.col(f"o{n}") < F.col(n), F.col(f"o{n}").isNotNull()) for n in names]
        changed = better[0]
        for b in better[1:]:
            changed = changed | b
        with stage_scope(spark) as paths:
            state = stage(state.drop("changed").join(offers, "node", "full")
                          .select("node", *[F.least(n, f"o{n}").alias(n) for n in names], changed.alias("changed")),
                          "landmark-round")
        remove_stages(spark, written)
        written = paths
        if state.where("changed").isEmpty():
            return state.drop("changed")


def landmark_axes(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(means, weights)`` from the squared distances between landmarks: a point with
    squared distances ``s`` lies at ``weights @ (means - s) / 2``. An axis along which
    the landmarks do not differ has no weights; the greatest weight is positive."""
    means = squared.mean(axis=0)
    centred = -0.5 * (squared - means[None, :] - means[:, None] + squared.mean())
    values, axes = np.linalg.eigh(centred)
    weights = np.zeros((2, len(squared)))
    for row, at in enumerate(np.argsort(-values, kind="stable")[:2]):
        if values[at] > 1e-9 * max(1.0, float(np.abs(values).max())):
            axis = axes[:, at] * np.sign(axes[np.argmax(np.abs(axes[:, at])), at])
            weights[row] = axis / np.sqrt(values[at])
    return means, weights


def _triangulated(distances: DataFrame, landmarks: list) -> DataFrame:
    names = [f"d{i}" for i in range(len(landmarks))]
    found = distances.agg(F.max(F.greatest(*names) if len(names) > 1 else F.col(names[0]))).first()[0]
    beyond = 2.0 * (found or 0) / UNIT
    at = {r["node"]: [r[n] for n in names] for r in distances.where(F.col("node").isin(landmarks)).collect()}
    between = np.array([[beyond if d is None else d / UNIT for d in at[m]] for m in landmarks])
    means, weights = landmark_axes(between ** 2)

    def place(w: np.ndarray) -> Column:
        total = F.lit(0.0)
        for n, mean, weight in zip(names, means.tolist(), w.tolist()):
            d = F.coalesce(F.col(n) / F.lit(float(UNIT)), F.lit(beyond))
            total = total + (F.lit(mean) - d * d) * F.lit(weight / 2)
        return total

    return distances.select("node", place(weights[0]).alias("x"), place(weights[1]).alias("y"))


def _smoothed(places: DataFrame, edges: DataFrame) -> DataFrame:
    means = (edges.select("src", F.col("dst").alias("node")).join(places, "node").groupBy(F.col("src").alias("node"))
             .agg(F.avg("x").alias("mx"), F.avg("y").alias("my")))
    return places.join(means, "node", "left").select(
        "node", *[((F.col(c) + F.coalesce(f"m{c}", c)) / 2).alias(c) for c in ("x", "y")])


def landmark_layout(vectors: DataFrame, key: str = "doc_id", vec: str = "vector", k: int = NEIGHBOURS,
                    landmarks: int = LANDMARKS, smoothing: int = SMOOTHING, **search) -> DataFrame:
    """``(key, x, y)`` for every row of ``vectors`` (see the module docstring)."""
    spark = vectors.sparkSession
    rows = _rows(vectors, key, vec)
    nodes = stage(distinct_vectors(vectors, key, vec), "layout-nodes")
    marks = choose_landmarks(nodes, landmarks)
    nowhere = [F.lit(None).cast("double").alias(c) for c in ("x", "y")]
    if not marks:
        return rows.select(key, *nowhere)
    with stage_scope(spark) as searched:
        edges = neighbor_graph(nodes, k, **search)
        kept = stage(edges, "layout-edges")
    remove_stages(spark, searched[:-1])
    # nodes out of every landmark's reach have no row there
    places = _triangulated(nodes.select("node").join(landmark_distances(kept, marks), "node", "left"), marks)
    places = stage(places, "layout-places")
    for _ in range(smoothing):
        places = stage(_smoothed(places, kept), "layout-places")
    by_vector = stage(nodes.join(places, "node", "left"), "layout-nodes").drop("node")
    return rows.join(by_vector.withColumn("placed", F.lit(True)), ["vector", "placed"], "left").select(key, "x", "y")
