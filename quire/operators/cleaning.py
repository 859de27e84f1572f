"""Document cleaning stages (TXT-7..10, TXT-14, FLT-3, FLT-5, AGG-11).

Pure ``DataFrame -> DataFrame`` functions. Each is a per-row projection or
filter: no shuffle, so they stream and scale linearly with the corpus.
Where the reference deletes a file, we drop the row; where it edits in
place, we return the new text in the same column.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T
from ..session import ship_package

# Fixed values (reference defaults): lines dropped by the front-matter
# script, the front-matter filter's cutoff (90th percentile of front-matter
# lines in a sample), and lines dropped by the gentle archival-note script.
FRONTMATTER_LINES = 10
FRONTMATTER_CUTOFF = 7
ARCHIVAL_LINES = 10


def remove_frontmatter(docs: DataFrame, n: int = FRONTMATTER_LINES, text: str = "text") -> DataFrame:
    """TXT-7: drop the first ``n`` lines of every document; short ones become ''."""
    return docs.withColumn(text, T.drop_first_lines(F.col(text), n))


def filter_frontmatter(docs: DataFrame, cutoff: int = FRONTMATTER_CUTOFF, text: str = "text") -> DataFrame:
    """TXT-8: drop the first ``cutoff`` lines and delete documents with nothing
    left. Lines keep their own terminators (the reference's space join is D13)."""
    return remove_frontmatter(docs, cutoff, text).where(F.col(text) != F.lit(""))


def remove_marked_front(docs: DataFrame, n: int = ARCHIVAL_LINES,
                        marker: str = T.ARCHIVAL_MARKER_RE, text: str = "text") -> DataFrame:
    """TXT-9 (gentle): drop the first ``n`` lines only of documents that have a
    line matching ``marker``."""
    t = F.col(text)
    return docs.withColumn(text, F.when(T.has_marker_line(t, marker), T.drop_first_lines(t, n))
                           .otherwise(t))


def drop_marked(docs: DataFrame, marker: str = T.ARCHIVAL_MARKER_RE, text: str = "text") -> DataFrame:
    """FLT-3 (harsh): drop documents that have a line matching ``marker``."""
    return docs.where(~T.has_marker_line(F.col(text), marker))


def remove_matching_lines(docs: DataFrame, line_regex: str = T.TRANSCRIPTION_ATTRIBUTION,
                          text: str = "text") -> DataFrame:
    """TXT-10: delete every line matching ``line_regex``."""
    return docs.withColumn(text, T.drop_matching_lines(F.col(text), line_regex))


def drop_empty(docs: DataFrame, text: str = "text") -> DataFrame:
    """FLT-5: remove zero-byte documents (whitespace-only ones survive)."""
    return docs.where(F.octet_length(F.col(text)) > 0)


def edit_counts(docs: DataFrame, marker: str = T.ARCHIVAL_MARKER_RE,
                line_regex: str = T.TRANSCRIPTION_ATTRIBUTION,
                frontmatter_lines: int = FRONTMATTER_LINES, text: str = "text") -> DataFrame:
    """AGG-11: what the cleaning scripts report, in one aggregate pass.

    The marker and attribution scripts count matching *lines*; the
    front-matter script counts *files*. Both numbers are reported."""
    t = F.col(text)
    return docs.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(T.count_matching_lines(t, marker)).cast("long").alias("marker_lines"),
        F.count_if(T.has_marker_line(t, marker)).alias("marker_docs"),
        F.sum(T.count_matching_lines(t, line_regex)).cast("long").alias("attribution_lines"),
        F.count_if(t.rlike(line_regex)).alias("attribution_docs"),
        F.count_if(F.size(T.lines(t)) > F.lit(0)).alias("frontmatter_files"),
    )


def remove_document_stopwords(docs: DataFrame, stopwords: Column | str, text: str = "text",
                              key: str = "doc_id") -> DataFrame:
    """TXT-14: normalise the whole text, split on whitespace, drop words that
    are in the per-document ``stopwords`` array, re-join with single spaces.
    Whole-word matches only; repeats and order of the kept words are preserved
    (not ``array_except``, which would deduplicate). A null stopword array
    means "no metadata": the text is left untouched.

    One pass, no shuffle, linear in tokens and stopwords: an Arrow-batched
    function looks each token up in the document's stopword set (an array
    lookup per token would cost tokens x stopwords, quadratic for a document
    whose title is long)."""
    ship_package(docs.sparkSession)
    stop_col = F.col(stopwords) if isinstance(stopwords, str) else stopwords
    tagged = docs.withColumn("_stop", stop_col)
    cols = [c for c in docs.columns if c != stopwords]
    # only the documents that have metadata travel to Python
    toks = F.when(F.col("_stop").isNotNull(), T.normalize(F.col(text)))
    kept = _without_words(toks, F.array_distinct("_stop"))
    return (tagged.withColumn("_kept", kept)
            .withColumn(text, F.when(F.col("_stop").isNull(), F.col(text)).otherwise(F.col("_kept")))
            .select(*cols))


@F.pandas_udf(StringType())
def _without_words(texts: pd.Series, stopwords: pd.Series) -> pd.Series:
    def one(text, stop):
        if text is None or stop is None:
            return None
        drop = set(stop)
        return " ".join([w for w in text.split() if w not in drop])

    return pd.Series([one(t, s) for t, s in zip(texts, stopwords)], dtype=object)


def metadata_stopwords(title: Column, locations: Column, split_locations: bool = False) -> Column:
    """TXT-11..13: distinct normalised title words and locations. Locations are
    normalised as whole strings (multi-word ones never match a token, D27)
    unless ``split_locations``."""
    locs = T.normalized_list(locations)
    if split_locations:
        locs = F.flatten(F.transform(locs, lambda s: T.split_ws(s)))
    return F.array_union(F.array_distinct(T.title_words(title)), locs)
