"""2-D layout of document vectors and the labelled output table (VEC-7,
VIZ-1, VIZ-2, ORD-1, JN-4, JN-5).

The reference runs UMAP on one machine. Here the layout is re-aimed at
distributed, linear projections:

* ``random_projection``: unit vectors projected on two seeded Gaussian
  directions -- a pure per-row expression, deterministic and exactly
  checkable;
* ``pca_projection``: ``pyspark.ml.feature.PCA(k=2)`` on unit vectors; the
  d x d covariance is the only thing that reaches the driver, so it scales
  with the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..functions import vectors as V
from ..session import stage
from .vocab import with_row_index

SHUFFLE_SEED = 20211


def projection_axes(dim: int, seed: int = 0) -> tuple[list[float], list[float]]:
    """Two seeded Gaussian directions of length ``dim`` (unit length)."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((2, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    return [float(x) for x in a[0]], [float(x) for x in a[1]]


def random_projection(vectors: DataFrame, dim: int, seed: int = 0, key: str = "doc_id",
                      vec: str = "vector") -> DataFrame:
    """``(key, x, y)``: the unit vector's coordinates on two seeded axes. A zero
    vector has no direction: its coordinates are null, and later stages leave
    the document out of the map."""
    ax, ay = projection_axes(dim, seed)
    v = vectors.select(key, F.col(vec).cast("array<double>").alias("_v"))
    v = v.withColumn("_n", V.norm("_v"))
    return v.select(key, F.try_divide(V.dot_literal("_v", ax), F.col("_n")).alias("x"),
                    F.try_divide(V.dot_literal("_v", ay), F.col("_n")).alias("y"))


def pca_projection(vectors: DataFrame, key: str = "doc_id", vec: str = "vector") -> DataFrame:
    """``(key, x, y)``: first two principal components of the unit vectors.
    (The sign of each component is not fixed by PCA.) Zero vectors take no
    part in the fit and have null coordinates."""
    v = vectors.select(key, F.col(vec).cast("array<double>").alias("_v"))
    v = v.withColumn("_n", V.norm("_v"))
    unit = v.select(key, "_n", array_to_vector(V.unit("_v", "_n")).alias("features"))
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(unit.where("_n > 0").select("features"))
    out = model.transform(unit).select(key, F.when(F.col("_n") > 0, vector_to_array("pc")).alias("pc"))
    return out.select(key, F.col("pc")[0].alias("x"), F.col("pc")[1].alias("y"))


def shuffle_key(key: str = "doc_id", seed: int = SHUFFLE_SEED):
    """ORD-1: a reproducible random order: md5 of seed and key (plain SQL has it
    too)."""
    return F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))


def shuffled(df: DataFrame, key: str = "doc_id", seed: int = SHUFFLE_SEED, stored: bool = False) -> DataFrame:
    """VIZ-2 / ORD-1: rows in a seeded random order (a distributed range sort;
    the CSV header is a writer option, so it stays first). The sort samples its
    input in a separate job and so reads a stored copy, unless ``df`` reads a
    stored table (``stored``): the work before it is done once."""
    df = df if stored else stage(df, "shuffle-rows")
    return df.orderBy(shuffle_key(key, seed), F.col(key))


def labelled_table(coordinates: DataFrame, metadata: DataFrame, score_words: Sequence[str],
                   key: str = "doc_id", json_lists: bool = True, include_key: bool = True) -> DataFrame:
    """VIZ-1 / JN-5: ``x, y``, the metadata fields in METADATA_ORDER and one
    column per keyword score. Rows without metadata are dropped (inner join);
    the score columns come from the explicit keyword list, not the first row
    (D20). Lists become JSON text when ``json_lists`` (for CSV output).
    ``include_key=False`` gives the reference's header exactly (x, y first)."""
    joined = coordinates.join(metadata, key, "inner")
    cols = ([F.col(key)] if include_key else []) + [F.col("x"), F.col("y")]
    for name in M.METADATA_ORDER:
        if name in metadata.columns:
            c = F.col(name)
            if json_lists and metadata.schema[name].dataType.typeName() in ("array", "map", "struct"):
                c = F.to_json(c)
            cols.append(c.alias(name))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    for w in score_words:
        cols.append(M.score_of(F.col(M.SCORE_NAMESPACE), w).alias(w))
    return joined.select(*cols)


def zip_positional(left: DataFrame, right: DataFrame) -> DataFrame:
    """JN-4: pair two unkeyed row sequences by position, truncating to the
    shorter (the reference's ``zip``). Positions are computed per file split
    plus per-split offsets, without moving rows to one task."""
    return with_row_index(left, "_pos").join(with_row_index(right, "_pos"), "_pos").drop("_pos")
