"""A vocabulary that grows with the corpus (AGG-13, AGG-1).

Documents land as files of ``(key, landed, text)``, ``landed`` being the number of a
document's version. A stream reads each file once. The newest version of each
document is kept as rows ``(key, landed, words, before)``, ``before`` being the words
that it replaced; a micro-batch meets the rows of its own documents in one sort by
key. An older or repeated version gives nothing. A batch's words, less those they
replaced, are counted and written to the batch's own partition. So are its documents;
both read only what earlier batches wrote, so that a retried batch writes the same
again and every landed file counts exactly once.

The vocabulary is the sum of the differences by word. ``compact`` replaces those up
to the last batch by their sums, and the documents by their newest versions, so that
both stay as long as vocabulary and corpus and not as the history; it may stop
anywhere and be run again.

Of one version that landed with several texts the greatest by its sorted words counts.
A null key is one document like any other; a null text has no words, and a version
with one takes the words of the document away. Rows with a null version are left out.
Words hold no line feed (the tokenizer's are cut at white space).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import tokenize
from ..operators.vocab import word_frequencies
from ..session import path_exists, remove_stages, ship_package

DIFFERENCE = T.StructType([T.StructField("word", T.StringType()), T.StructField("tf", T.LongType()),
                           T.StructField("df", T.LongType())])


def _order(version: tuple[int, str]) -> tuple:
    return version[0], sorted(Counter(version[1].split("\n") if version[1] else []).items())


def _newer(version: tuple[int, str], best: tuple[int, str] | None) -> bool:
    if best is None or version[0] != best[0]:
        return best is None or version[0] > best[0]
    return version[1] != best[1] and _order(version) > _order(best)


def _replacing(kind: pa.DataType):
    """Rows ``(side, key, landed, words)`` sorted by key and side (0: known, 1: landed)
    to the documents whose newest version landed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, best = (), None, None  # the key that may go on (none: ()), and its versions

        def changed() -> list[tuple]:
            if at == () or best is known:
                return []
            return [(at[0], *best, None if known is None else known[1])]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            keys, landed, words, before = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array(landed, pa.int64()), pa.array(words, pa.string()),
                 pa.array(before, pa.string())], names=["key", "landed", "words", "before"])

        for batch in batches:
            out = []
            for side, key, landed, words in zip(*[c.to_pylist() for c in batch.columns]):
                if at == () or at[0] != key:
                    out += changed()
                    at, known, best = (key,), None, None
                version = (landed, words or "")
                if _newer(version, best):
                    best = version
                    known = known if side else best
            if out:
                yield batch_of(out)
        out = changed()
        if out:
            yield batch_of(out)
    return run


def _documents(spark: SparkSession, path: str, kind: T.DataType, before: int) -> DataFrame | None:
    """The versions ``(key, landed, words)`` that batches earlier than ``before`` kept."""
    schema = T.StructType([T.StructField("key", kind), T.StructField("landed", T.LongType()),
                           T.StructField("words", T.StringType())])
    parts, (upto, _) = [], _whole(spark, f"{path}/newest")
    if upto >= 0:
        parts.append(spark.read.schema(schema).parquet(f"{path}/newest/upto={upto}"))
    if path_exists(spark, f"{path}/documents"):
        later = (F.col("batch_id") > upto) & (F.col("batch_id") < before)
        parts.append(spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
                     .parquet(f"{path}/documents").where(later).drop("batch_id"))
    return parts[0].unionByName(parts[-1]) if len(parts) > 1 else parts[0] if parts else None


def _write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def take_in(batch: DataFrame, batch_id: int, path: str, tokenizer=tokenize) -> None:
    """A batch's rows ``(key, landed, text)``: its new versions, then their differences."""
    spark, kind = batch.sparkSession, batch.schema["key"].dataType
    rows = batch.select(F.lit(1).alias("side"), "key", "landed", F.array_join(tokenizer(F.col("text")), "\n").alias("words"))
    known = _documents(spark, path, kind, batch_id)
    if known is not None:
        asked = batch.select(F.col("key").alias("_asked")).distinct()
        known = known.join(asked, F.col("key").eqNullSafe(F.col("_asked")), "left_semi")
        rows = rows.unionByName(known.select(F.lit(0).alias("side"), "key", "landed", "words"))
    schema = T.StructType([T.StructField("key", kind), T.StructField("landed", T.LongType()),
                           T.StructField("words", T.StringType()), T.StructField("before", T.StringType())])
    changed = (rows.repartition("key").sortWithinPartitions("key", "side")
               .mapInArrow(_replacing(to_arrow_type(kind)), schema))
    _write_batch(changed, f"{path}/documents", batch_id)
    stored = (spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())]))
              .parquet(f"{path}/documents").where(F.col("batch_id") == batch_id))

    def counted(column: str, sign: int) -> DataFrame:
        words = stored.where(F.col(column) != "").select(F.split(column, "\n").alias("tokens"))
        return word_frequencies(words).select("word", (F.col("tf") * sign).alias("tf"), (F.col("df") * sign).alias("df"))

    summed = (counted("words", 1).unionByName(counted("before", -1)).groupBy("word")
              .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")).where("tf <> 0 OR df <> 0"))
    _write_batch(summed, f"{path}/differences", batch_id)


def update_vocabulary(landed: DataFrame, path: str, checkpoint: str, key: str = "doc_id", version: str = "landed",
                      text: str = "text", tokenizer=tokenize) -> None:
    """Take in what has landed since the last run on this ``checkpoint``."""
    ship_package(landed.sparkSession)
    rows = landed.where(F.col(version).isNotNull()).select(
        F.col(key).alias("key"), F.col(version).cast("long").alias("landed"), F.col(text).alias("text"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        take_in(batch, batch_id, path, tokenizer)

    query = (rows.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def _whole(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The batch up to which a folder ``upto=`` is whole (-1: none), and all folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place):
        return -1, []
    folders = [f.getPath().toString() for f in store.listStatus(place)]
    whole = [int(f.rsplit("=", 1)[1]) for f in folders if path_exists(spark, f"{f}/_SUCCESS")]
    return max(whole, default=-1), folders


def _history(spark: SparkSession, path: str, upto: int) -> DataFrame:
    schema = T.StructType([*DIFFERENCE.fields, T.StructField("batch_id", T.IntegerType())])
    if path_exists(spark, f"{path}/differences"):
        rows = spark.read.schema(schema).parquet(f"{path}/differences").where(F.col("batch_id") > upto).drop("batch_id")
    else:
        rows = spark.createDataFrame([], DIFFERENCE)
    if upto >= 0:
        rows = rows.unionByName(spark.read.schema(DIFFERENCE).parquet(f"{path}/sums/upto={upto}"))
    return rows.groupBy("word").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")).where("df > 0")


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(word, tf, df)`` of the newest version of every document taken in."""
    return _history(spark, path, _whole(spark, f"{path}/sums")[0])


def _batches(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, path):
        return []
    found = spark.read.schema("batch_id int").parquet(path).select("batch_id").distinct()
    return [r["batch_id"] for r in found.collect()]  # one number a batch since the last run


def compact(spark: SparkSession, path: str) -> None:
    """Sum up the differences so far, then keep the newest versions of documents only.
    Not while an update or a reader is running."""
    ids = _batches(spark, f"{path}/differences")
    upto, folders = _whole(spark, f"{path}/sums")
    last = max([upto, *ids])
    if last > upto:
        _history(spark, path, upto).write.mode("overwrite").parquet(f"{path}/sums/upto={last}")
    # the sums come first: a batch that is retried after them finds its documents known
    _compact_documents(spark, path)
    remove_stages(spark, [f for f in folders if not f.endswith(f"upto={last}")])
    remove_stages(spark, [f"{path}/differences/batch_id={b}" for b in ids])


def _compact_documents(spark: SparkSession, path: str) -> None:
    ids = _batches(spark, f"{path}/documents")
    upto, folders = _whole(spark, f"{path}/newest")
    last = max([upto, *ids])
    if last > upto:
        parts = [spark.read.parquet(f"{path}/documents").where(F.col("batch_id") > upto)
                 .select("key", "landed", "words", "batch_id")]
        if upto >= 0:
            parts.append(spark.read.parquet(f"{path}/newest/upto={upto}").select("*", F.lit(upto).alias("batch_id")))
        rows = parts[0].unionByName(parts[-1]) if len(parts) > 1 else parts[0]
        # of a document, every later batch's version is the newer one
        newest = rows.groupBy("key").agg(F.max_by(F.struct("landed", "words"), "batch_id").alias("v"))
        newest.select("key", "v.landed", "v.words").write.mode("overwrite").parquet(f"{path}/newest/upto={last}")
    remove_stages(spark, [f for f in folders if not f.endswith(f"upto={last}")])
    remove_stages(spark, [f"{path}/documents/batch_id={b}" for b in ids])
