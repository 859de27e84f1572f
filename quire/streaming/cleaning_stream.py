"""Structured Streaming form of the per-document stages.

The reference has no streams; its rerun-skips-finished-files behaviour
(SNK-11) is what a file stream source with a checkpoint gives for free:
files already processed are never read again. Stateless stages (TXT-7..10,
FLT-3, FLT-5) are plain projections/filters on the stream. Stages that
aggregate per document or join a large table (FLT-2, TXT-15) run per
micro-batch through ``foreachBatch``, writing each batch to its own
partition so that a retried batch overwrites itself (idempotent).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, corrections, quality
from ..session import ensure_checkpoint_dir, stage


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the session's shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_table_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet file stream over one table, which is a folder of files or a
    single file (a stream's path must be a folder: that of the file)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    if status.isDirectory():
        return read_documents_stream(spark, path, schema)
    folder, _, name = path.rpartition("/")
    return read_documents_stream(spark, folder or ("/" if path.startswith("/") else "."), schema, glob=name)


def read_documents_stream(spark: SparkSession, directory: str, schema, glob: str | None = None) -> DataFrame:
    """A parquet file stream over ``directory`` (optionally only files
    matching ``glob``); new files are picked up by later triggers."""
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(directory)


def clean(stream: DataFrame, marker: str, line_regex: str, frontmatter_lines: int | None = None) -> DataFrame:
    """Stateless cleaning chain; works on batch and streaming DataFrames."""
    out = cleaning.drop_marked(stream, marker=marker)
    out = cleaning.remove_matching_lines(out, line_regex)
    if frontmatter_lines:
        out = cleaning.remove_frontmatter(out, frontmatter_lines)
    return cleaning.drop_empty(out)


def run_to_parquet(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything available now, then stop (batch-like rerun)."""
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(sink))
    q.awaitTermination()


def quality_filter_batches(stream: DataFrame, dictionary: DataFrame, sink: str, checkpoint: str,
                           cutoff: float = quality.CUTOFF) -> None:
    """FLT-2 on a stream: each micro-batch is scored as a batch job. The
    dictionary is stored once, before the stream starts."""
    dictionary = stage(dictionary.select("word").distinct(), "dictionary")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        kept = quality.quality_filter(batch, dictionary, cutoff=cutoff, stored=True).select("doc_id")
        out = batch.join(kept, "doc_id", "left_semi").withColumn("batch_id", F.lit(batch_id))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink))

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def replace_nonwords_batches(stream: DataFrame, dictionary: DataFrame, correction_table: DataFrame,
                             sink: str, checkpoint: str, key: str = "doc_id") -> None:
    """TXT-15 on a stream: each micro-batch is rewritten with the (static)
    dictionary and correction table; a retried batch overwrites its own
    partition. Both tables are stored once, before the stream starts."""
    dictionary, correction_table = stage(dictionary, "dictionary"), stage(correction_table, "corrections")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = corrections.replace_nonwords(batch, dictionary, correction_table, key=key)
        (out.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink))

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
