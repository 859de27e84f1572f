"""Joins with hot keys: the same rows, copies of hot keys only, even tasks."""

from statistics import median

from pyspark.sql import functions as F

from quire.operators import skew
from quire.session import stage

TASKS = 8


def _tables(spark, n=30_000):
    """A third of the rows have one key, a tenth another; the others are spread."""
    i = F.col("id")
    k = F.when(i % 3 == 0, F.lit("hot")).when(i % 10 == 1, F.lit("warm")).otherwise(F.concat(F.lit("k"), i % 997))
    rows = stage(spark.range(n).select(i, F.when(i % 1000 != 7, k).alias("k")), "rows")
    lookup = spark.range(900).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([("hot", -1), ("unused", -3)], "k string, v long"))
    return rows, lookup


def _sorted(df):
    return sorted((tuple(r) for r in df.select("id", "k", "v").collect()), key=repr)


def test_same_rows_as_the_plain_join(spark):
    rows, lookup = _tables(spark, 5_000)
    for how in ("left", "inner"):
        assert _sorted(skew.spread_join(rows, lookup, "k", "id", how, TASKS)) == _sorted(rows.join(lookup, "k", how))
    none = rows.limit(0)
    assert skew.spread_join(none, lookup, "k", "id", "left", TASKS).collect() == []
    assert skew.hot_keys(rows.where("k IS NULL"), "k", TASKS) == {}


def test_only_hot_keys_have_parts_by_their_share(spark):
    rows, _ = _tables(spark)
    hot = skew.hot_keys(rows, "k", 16)
    assert set(hot) == {"hot", "warm"}
    assert abs(hot["hot"] - 16 * skew.FINE / 3) <= 0.02 * 16 * skew.FINE
    assert set(skew.hot_keys(rows, "k", 4)) == {"hot"}
    assert skew.hot_keys(rows.where("k LIKE 'k%'"), "k", TASKS) == {}


def test_tasks_are_even(spark):
    rows, lookup = _tables(spark)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": str(TASKS)}
    old = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)

        def largest(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            return max(sizes) / median(sizes + [0] * (TASKS - len(sizes)))
        some = rows.where("k IS NOT NULL")
        assert largest(some.join(lookup, "k", "left")) > 3
        assert largest(skew.spread_join(some, lookup, "k", "id", "left", TASKS)) < 2
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
