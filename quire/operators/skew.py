"""Joins whose keys may be hot: one key may hold a third of all rows (JN-6, JN-11).

The rows' keys go through Spark's frequent-items sketch (``approx_top_k``), which is
mergeable and of bounded size: partial sketches of the tasks are all that is
shuffled. Keys above ``1 / tasks`` of the rows are hot; the sketch's error is a
sixth of that share, and there are at most ``2 * tasks`` of them. The rows of a hot
key are dealt over parts, in number by the key's share, by a hash of ``by``; only
the lookup rows of hot keys are copied, once for each part. With no hot key the
join is the plain one.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINE = 16           # parts of a hot key for each task's worth of its rows
MOST_TRACKED = 1_000_000


def hot_keys(rows: DataFrame, key: str, tasks: int) -> dict:
    """``{key: parts}`` of the keys that hold more than ``1 / tasks`` of the rows."""
    listed, tracked = min(2 * tasks, MOST_TRACKED), min(16 * tasks, MOST_TRACKED)
    found = (rows.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
             .agg(F.expr(f"approx_top_k(k, {listed}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first())
    return {t["item"]: ceil(FINE * tasks * t["count"] / found["n"])
            for t in found["top"] or [] if t["count"] * tasks > found["n"]}


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, by: str, how: str = "left",
                tasks: int | None = None) -> DataFrame:
    """``rows.join(lookup, key, how)`` for ``how`` inner or left, with the rows of hot
    keys spread by ``by``. ``rows`` is read twice: hand over stored rows."""
    if how not in ("inner", "left"):
        raise ValueError(f"no spread join of kind {how!r}")
    spark = rows.sparkSession
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    hot = hot_keys(rows, key, tasks)
    if not hot:
        return rows.join(lookup, key, how)
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("_parts", T.IntegerType())])
    shares = F.broadcast(spark.createDataFrame(list(hot.items()), schema))  # at most 2 * tasks rows
    dealt = rows.join(shares, key, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    copied = lookup.join(shares, key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copied, [key, "_part"], how).drop("_part")
