"""Harvest and corpus statistics (AGG-2, AGG-3, AGG-4, TXT-17, FLT-22).

One aggregate pass each; grand totals come from ``rollup`` rather than a
second job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count


def _found(text):
    """FLT-22: a document counts as found when its full text is non-empty."""
    return F.coalesce(F.length(text) > F.lit(0), F.lit(False))


def harvest_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """AGG-2: processed / found / total_words / not_found / failed.

    ``failed`` are rows whose text could not be obtained at all (null);
    ``not_found`` have an empty text."""
    t = F.col(text)
    found = _found(t)
    return docs.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(found).alias("found"),
        F.coalesce(F.sum(F.when(found, word_count(t))), F.lit(0)).cast("long").alias("total_words"),
        F.count_if(t.isNotNull() & ~found).alias("not_found"),
        F.count_if(t.isNull()).alias("failed"),
    )


def collection_stats(docs: DataFrame, collection: str, text: str = "text") -> DataFrame:
    """AGG-3: documents found and words per collection plus a grand total row
    (``collection`` null, ``is_total`` true)."""
    t = F.col(text)
    found = _found(t)
    return (docs.rollup(collection)
            .agg(F.count(F.lit(1)).alias("total_docs"),
                 F.count_if(found).alias("found"),
                 F.coalesce(F.sum(F.when(found, word_count(t))), F.lit(0)).cast("long").alias("words"),
                 F.grouping(collection).cast("boolean").alias("is_total")))


def value_counts(df: DataFrame, array_col: str, name: str = "value") -> DataFrame:
    """AGG-4: frequency of each element of an array column (the subject log),
    most frequent first. ``explode_outer`` keeps rows without values as null."""
    return (df.select(F.explode_outer(F.col(array_col)).alias(name))
            .groupBy(name).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(name).asc_nulls_last()))
