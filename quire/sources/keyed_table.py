"""A table with one row a key that incremental runs extend (SNK-11, JN-7).

The table is partitioned by a hash bucket of its key. A run

1. finishes or drops what an interrupted run left (below);
2. takes one row of each new key (the least by ``order``, then by its JSON text);
3. reads only the buckets that hold a new row's key, drops the keys that are there
   already (the first row of a key wins, whatever later runs say), and writes the
   buckets that gain a row, old and new rows together, to ``<path>/_pending``;
4. marks that copy as whole (``<path>/_ready``), replaces just those buckets by a
   dynamic partition overwrite, and removes the mark and the copy.

A run that dies before the mark has changed nothing, and the next one drops its
copy. One that dies after it may have replaced some buckets; the next run replaces
them again from the copy, which gives the same rows. So a run can be repeated at
any point, and tasks that lose their executor are Spark's to retry. While buckets
are replaced a reader may miss some of them. Two runs at a time on one path are not
supported.

A null key is a key like any other. Stored rows and new rows must have the same
columns, and the number of buckets is part of the table (its partition column is
``bucket_of_<n>``); anything else is an error that leaves the table as it is. An
empty first run writes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists, remove_stages, stage_path

BUCKETS = 64


def _column(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def _touch(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True).close()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it is stored, if it has any bucket."""
    if not path_exists(spark, path):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    if not any(f.getPath().getName().startswith("bucket_of_") for f in files):
        if any(not f.getPath().getName().startswith(("_", ".")) for f in files):
            raise ValueError(f"{path} holds something other than a keyed table")
        return None
    return spark.read.parquet(path)


def recover(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Finish the replacement that an earlier run marked as whole; drop a copy
    that was not."""
    pending, ready = f"{path}/_pending", f"{path}/_ready"
    if path_exists(spark, ready):
        (spark.read.parquet(pending).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(_column(buckets)).parquet(path))
        remove_stages(spark, [ready])
    if path_exists(spark, pending):
        remove_stages(spark, [pending])


def prepare(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, order: list[str] | None = None) -> bool:
    """Steps 1 to 3 and the mark; whether there is anything to replace."""
    spark, bucket = df.sparkSession, _column(buckets)
    if key not in df.columns or bucket in df.columns:
        raise ValueError(f"the new rows need a column {key!r} and none named {bucket!r}")
    stored = _stored(spark, path)
    if stored is not None and bucket not in stored.columns:
        raise ValueError(f"{path} has another number of buckets than {buckets}")
    if stored is not None and sorted(stored.columns) != sorted([*df.columns, bucket]):
        raise ValueError(f"{path} has other columns: {sorted(stored.columns)}")
    recover(spark, path, buckets)
    stored = _stored(spark, path)
    named = [F.col(f"`{c}`") for c in df.columns]
    row = F.struct(*named)
    first = F.struct(*[F.col(f"`{c}`") for c in order or []], F.to_json(row))
    # written once: the touched buckets, the fresh rows and the merge read the same rows
    new_path = stage_path(spark, "new-rows")
    (df.select(F.col(f"`{key}`").alias("k"), row.alias("row"), first.alias("first"))
     .groupBy("k").agg(F.min_by("row", "first").alias("row"))
     .withColumn("b", F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int")).write.parquet(new_path))
    new = spark.read.parquet(new_path)
    try:
        if stored is not None:
            touched = [r["b"] for r in new.select("b").distinct().collect()]  # at most ``buckets`` numbers
            old = (stored.where(F.col(bucket).isin(touched))
                   .select(F.col(f"`{key}`").alias("k"), F.struct(*named).alias("row"), F.col(bucket).alias("b")))
            new = new.join(old.select("k", "b"), new["b"].eqNullSafe(old["b"]) & new["k"].eqNullSafe(old["k"]), "left_anti")
            gains = [r["b"] for r in new.select("b").distinct().collect()]
            rows = old.where(F.col("b").isin(gains)).select("row", "b").unionByName(new.select("row", "b"))
        else:
            gains = [r["b"] for r in new.select("b").distinct().collect()]
            rows = new.select("row", "b")
        if not gains:
            return False
        # a bucket's rows together; adaptive execution splits one that is too large for a task
        (rows.hint("rebalance", "b").select("row.*", F.col("b").alias(bucket))
         .write.mode("overwrite").partitionBy(bucket).parquet(f"{path}/_pending"))
        _touch(spark, f"{path}/_ready")
        return True
    finally:
        remove_stages(spark, [new_path])


def add_new(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, order: list[str] | None = None) -> None:
    """Add the rows of ``df`` whose key the table at ``path`` does not have yet."""
    if prepare(df, path, key, buckets, order):
        recover(df.sparkSession, path, buckets)


def read_keyed(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The table without its bucket column."""
    return spark.read.parquet(path).drop(_column(buckets))
