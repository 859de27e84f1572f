"""Cleaning, filtering and statistics queries over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, filters, stats
from ..sources.tables import table
from .fixtures import SQL_METADATA, corpus_metadata
from .registry import register
from .sqlfrag import normalize as sql_normalize
from .sqlfrag import split_ws as sql_split_ws
from .sqlfrag import sql_str
from .sqlfrag import tokens as sql_tokens

# Parameters for the driver corpus. The archival marker of the reference never
# occurs in it, so licence lines play the marker role.
MARKER = r"(Licensed|Released) under [A-Za-z ]+"
REPEATED_LINE = "The and attion to thanedble the, anea. Eriner thanea."
BLOCKLIST = ["SRC3", "FR", "Src7"]


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _drop_lines_sql(n: int, strict: bool) -> str:
    body = f"array_to_string(string_split(text, chr(10))[{n + 1}:], chr(10))"
    if strict:
        return f"SELECT doc_id, t AS text FROM (SELECT doc_id, {body} AS t FROM documents) WHERE t <> ''"
    return f"SELECT doc_id, {body} AS text FROM documents"


@register("drop_first_lines", _drop_lines_sql(cleaning.FRONTMATTER_LINES, False))
def q_drop_first_lines(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.remove_frontmatter(_docs(spark, sf).select("doc_id", "text"))


@register("drop_first_lines_strict", _drop_lines_sql(cleaning.FRONTMATTER_CUTOFF, True))
def q_drop_first_lines_strict(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.filter_frontmatter(_docs(spark, sf).select("doc_id", "text"))


@register("marker_trim", f"""
SELECT doc_id,
       CASE WHEN regexp_matches(text, {sql_str(MARKER)})
            THEN array_to_string(string_split(text, chr(10))[{cleaning.ARCHIVAL_LINES + 1}:], chr(10))
            ELSE text END AS text
FROM documents""")
def q_marker_trim(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.remove_marked_front(_docs(spark, sf).select("doc_id", "text"), marker=MARKER)


@register("marker_drop", f"""
SELECT doc_id, n_chars FROM documents WHERE NOT regexp_matches(text, {sql_str(MARKER)})""")
def q_marker_drop(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_marked(_docs(spark, sf).select("doc_id", "n_chars", "text"),
                                marker=MARKER).drop("text")


@register("drop_matching_lines", f"""
SELECT doc_id,
       array_to_string(list_filter(string_split(text, chr(10)),
                                   lambda l: NOT regexp_matches(l, {sql_str(REPEATED_LINE)})), chr(10)) AS text
FROM documents""")
def q_drop_matching_lines(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.remove_matching_lines(_docs(spark, sf).select("doc_id", "text"), REPEATED_LINE)


@register("drop_empty", "SELECT doc_id FROM documents WHERE octet_length(encode(text)) > 0")
def q_drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_empty(_docs(spark, sf).select("doc_id", "text")).select("doc_id")


@register("edit_counts", f"""
SELECT count(*) AS documents,
       CAST(sum(len(list_filter(string_split(text, chr(10)),
                                lambda l: regexp_matches(l, {sql_str(MARKER)})))) AS BIGINT) AS marker_lines,
       count(*) FILTER (WHERE regexp_matches(text, {sql_str(MARKER)})) AS marker_docs,
       CAST(sum(len(list_filter(string_split(text, chr(10)),
                                lambda l: regexp_matches(l, {sql_str(REPEATED_LINE)})))) AS BIGINT) AS attribution_lines,
       count(*) FILTER (WHERE regexp_matches(text, {sql_str(REPEATED_LINE)})) AS attribution_docs,
       count(*) AS frontmatter_files
FROM documents""")
def q_edit_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.edit_counts(_docs(spark, sf).select("text"), marker=MARKER, line_regex=REPEATED_LINE)


@register("harvest_stats", """
SELECT count(*) AS processed,
       count(*) FILTER (WHERE length(text) > 0) AS found,
       CAST(coalesce(sum(len(string_split(text, ' '))) FILTER (WHERE length(text) > 0), 0) AS BIGINT) AS total_words,
       count(*) FILTER (WHERE text IS NOT NULL AND length(text) = 0) AS not_found,
       count(*) FILTER (WHERE text IS NULL) AS failed
FROM documents""")
def q_harvest_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.harvest_stats(_docs(spark, sf).select("text"))


@register("collection_stats", """
SELECT source, count(*) AS total_docs,
       count(*) FILTER (WHERE length(text) > 0) AS found,
       CAST(coalesce(sum(len(string_split(text, ' '))) FILTER (WHERE length(text) > 0), 0) AS BIGINT) AS words,
       grouping(source) = 1 AS is_total
FROM documents GROUP BY ROLLUP (source)""")
def q_collection_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.collection_stats(_docs(spark, sf).select("source", "text"), "source")


_SQL_STOP = (f"list_distinct(list_concat("
             f"list_transform({sql_split_ws('title')}, lambda w: {sql_normalize('w')}), "
             f"list_transform(locations, lambda w: {sql_normalize('w')})))")


@register("metadata_stopwords", f"""
WITH {SQL_METADATA},
stop AS (SELECT doc_id, {_SQL_STOP} AS stop FROM meta)
SELECT d.doc_id,
       CASE WHEN s.stop IS NULL THEN d.text
            ELSE array_to_string(list_filter({sql_tokens('d.text')}, lambda w: NOT list_contains(s.stop, w)), ' ')
       END AS text
FROM documents d LEFT JOIN stop s ON d.doc_id = s.doc_id""")
def q_metadata_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    meta = corpus_metadata(spark, sf).select(
        "doc_id", cleaning.metadata_stopwords(F.col("title"), F.col("locations")).alias("stop"))
    docs = _docs(spark, sf).select("doc_id", "text").join(meta, "doc_id", "left")
    return cleaning.remove_document_stopwords(docs, "stop").select("doc_id", "text")


@register("collection_blocklist", f"""
WITH {SQL_METADATA}
SELECT d.doc_id FROM documents d LEFT JOIN meta m ON d.doc_id = m.doc_id
WHERE m.collections IS NULL
   OR NOT list_has_any(list_transform(m.collections, lambda c: lower(c)),
                       [{", ".join(sql_str(b.lower()) for b in BLOCKLIST)}])""")
def q_collection_blocklist(spark: SparkSession, sf: str) -> DataFrame:
    meta = corpus_metadata(spark, sf).select("doc_id", "collections")
    return filters.collection_blocklist(_docs(spark, sf).select("doc_id"), meta, BLOCKLIST)


@register("stream_clean", f"""
WITH k AS (SELECT doc_id, text FROM documents WHERE NOT regexp_matches(text, {sql_str(MARKER)})),
c AS (SELECT doc_id,
             array_to_string(list_filter(string_split(text, chr(10)),
                                         lambda l: NOT regexp_matches(l, {sql_str(REPEATED_LINE)})), chr(10)) AS text
      FROM k)
SELECT doc_id, text FROM c WHERE octet_length(encode(text)) > 0""")
def q_stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning chain run as a Structured Streaming query over the
    documents table (availableNow trigger), read back from its sink."""
    from ..streaming import cleaning_stream as S
    src = f"{sf.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(src).schema
    stream = S.read_table_stream(spark, src, schema).select("doc_id", "text")
    sink = S.scratch_path(spark, "stream-clean")
    cleaned = S.clean(stream, MARKER, REPEATED_LINE)
    S.run_to_parquet(cleaned, sink, sink + "-checkpoint")
    return spark.read.schema(cleaned.schema).parquet(sink)
