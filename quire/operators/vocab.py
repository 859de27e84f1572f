"""Vocabulary operators: term / document frequency (AGG-1, AGG-13, FLT-18) and
dictionary derivation (SRC-12).

Frequencies are computed in a single shuffle: each document's tokens are
sorted in-row so that the first occurrence of a word in the document can be
flagged without a per-document group-by; the exploded rows are then
aggregated by word, which Spark pre-aggregates map-side (a hot word such as
"the" collapses to one row per map task before it is shuffled).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokenize
from ..session import materialize, path_exists


def word_frequencies(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """AGG-1: ``(word, tf, df)`` over a DataFrame holding a token array column.

    Each token is paired with its predecessor in the *sorted* token array
    (``arrays_zip`` with a shifted copy: native expressions, no lambda); a
    token starts a new run -- first occurrence in its document -- when it
    differs from its predecessor. The sort runs in its own projection so the
    generator refers to it as an attribute instead of re-sorting per use."""
    srt = docs.select(F.sort_array(F.col(tokens)).alias("_s"))
    prev = F.slice(F.concat(F.array(F.lit(None).cast("string")), F.col("_s")), 1, F.size("_s"))
    pairs = srt.select(F.explode(F.arrays_zip(F.col("_s").alias("w"), prev.alias("p"))).alias("z"))
    first = F.col("z.p").isNull() | (F.col("z.p") != F.col("z.w"))
    return (pairs.groupBy(F.col("z.w").alias("word"))
            .agg(F.count(F.lit(1)).alias("tf"), F.count_if(first).alias("df")))


def term_frequency(documents: DataFrame, min_frequency: int = 0,
                   text: str = "text", tokenizer=tokenize) -> DataFrame:
    """AGG-1 + FLT-18: frequencies of preprocessed tokens, keeping ``tf > min``
    (strict, as the reference's dictionary build)."""
    toks = documents.select(tokenizer(F.col(text)).alias("tokens"))
    out = word_frequencies(toks)
    if min_frequency:
        out = out.where(F.col("tf") > F.lit(min_frequency))
    return out


def dictionary_by_df(documents: DataFrame, min_df: int, text: str = "text") -> DataFrame:
    """SRC-12 fallback: a ``dictionary(word)`` derived from the corpus itself as
    the words occurring in at least ``min_df`` documents."""
    return (term_frequency(documents, text=text)
            .where(F.col("df") >= F.lit(min_df))
            .select("word"))


def vocabulary(spark, documents: DataFrame | None = None, saved_path: str | None = None,
               min_frequency: int = 0) -> DataFrame:
    """AGG-13: the training vocabulary from saved frequencies when the path
    exists, otherwise computed from the corpus. Any other read error (a broken
    file, missing rights) is raised, not taken for absence."""
    if saved_path and (documents is None or path_exists(spark, saved_path)):
        saved = spark.read.parquet(saved_path)
        return saved.where(F.col("tf") > F.lit(min_frequency)) if min_frequency else saved
    return term_frequency(documents, min_frequency=min_frequency)


def with_row_index(df: DataFrame, name: str = "index", order: list[Column] | None = None,
                   stored: bool = False) -> DataFrame:
    """Attach a dense 0-based row index: in ``order`` when given (a distributed
    range sort), otherwise in the current row order (file order for a scan).

    No row moves to a single task: each partition numbers its own rows
    (``monotonically_increasing_id`` is consecutive within a partition) and
    per-partition offsets -- one row per partition -- are added. The numbered
    rows are checkpointed, so that the offsets and the join read the very same
    partitions whatever columns each of them needs."""
    if order:
        # the range partitioner samples its input in a separate job: read a
        # materialised copy (unless ``df`` reads a stored table) instead of
        # recomputing the input twice
        df = df if stored else materialize(df)
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    keyed = materialize(df.withColumn("_pid", F.spark_partition_id())
                        .withColumn("_local", F.monotonically_increasing_id()
                                    - F.shiftleft(F.col("_pid").cast("long"), 33)))
    sizes = keyed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition, so a global window here is bounded
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    return (keyed.join(F.broadcast(offsets), "_pid")
            .select(*df.columns, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_local")).alias(name)))


def rank_words(freq: DataFrame, order: list[Column] | None = None, stored: bool = False) -> DataFrame:
    """Attach a dense 0-based ``rank`` to every word ordered by (df desc, word)."""
    order = order or [F.col("df").desc(), F.col("word").asc()]
    return with_row_index(freq, "rank", order, stored)
