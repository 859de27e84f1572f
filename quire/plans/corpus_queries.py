"""Queries over the driver's corpus tables, with DuckDB oracles.

Each query reads whole tables (or data Spark derives from them); nothing is
subset to keep the check cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import quality, vocab
from ..session import stage
from ..sources.tables import table
from .registry import register
from .sqlfrag import split_ws, sql_str
from .sqlfrag import tokens as sql_tokens

# Fixture parameters for the driver tables.
MIN_FREQUENCY = 2          # term_frequency keeps tf > 2 (strict, as the reference)
DICTIONARY_MIN_DF = 5      # derived dictionary: words in >= 5 documents


def corpus_dictionary(documents: DataFrame) -> DataFrame:
    return vocab.dictionary_by_df(documents, DICTIONARY_MIN_DF)


SQL_TOKENS = f"""toks AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)"""
SQL_DICTIONARY = f"""dict AS (
    SELECT w AS word FROM (SELECT DISTINCT doc_id, unnest(t) AS w FROM toks)
    GROUP BY w HAVING count(*) >= {DICTIONARY_MIN_DF})"""


@register("term_frequency", f"""
WITH {SQL_TOKENS},
w AS (SELECT doc_id, unnest(t) AS word FROM toks)
SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df
FROM w GROUP BY word HAVING count(*) > {MIN_FREQUENCY}
""")
def q_term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.term_frequency(table(spark, sf, "documents"), min_frequency=MIN_FREQUENCY)


def _sql_quality(window: str) -> str:
    return f"""
WITH {SQL_TOKENS}, {SQL_DICTIONARY},
ex AS (SELECT doc_id,
              unnest(list_distinct(list_filter(t{window}, lambda x: length(x) > {quality.MIN_WORD_LENGTH}))) AS word
       FROM toks),
sc AS (SELECT ex.doc_id, count(*) AS n_tokens, count(dict.word) AS n_good
       FROM ex LEFT JOIN dict ON ex.word = dict.word GROUP BY ex.doc_id)"""


SQL_QUALITY = _sql_quality("")
SQL_KEPT = f"""
SELECT doc_id, n_tokens, n_good, round(n_good::DOUBLE / n_tokens, 6) AS score
FROM sc WHERE n_good::DOUBLE / n_tokens >= {quality.CUTOFF}
"""


def _quality_scores(spark: SparkSession, sf: str, **kw) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.quality_scores(docs, stage(corpus_dictionary(docs), "dictionary"), stored=True, **kw)


def _kept(scores: DataFrame) -> DataFrame:
    return (scores.where(F.col("score") >= F.lit(quality.CUTOFF))
            .select("doc_id", "n_tokens", "n_good", F.round("score", 6).alias("score")))


@register("ocr_quality_filter", SQL_QUALITY + SQL_KEPT)
def q_ocr_quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2 over whole texts."""
    return _kept(_quality_scores(spark, sf))


@register("ocr_quality_reference_window", _sql_quality(f"[1:{quality.REFERENCE_WINDOW}]") + SQL_KEPT)
def q_ocr_quality_reference_window(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2 as the reference defines it: its feature is to judge a text by its
    first 400 tokens."""
    return _kept(_quality_scores(spark, sf, words_to_examine=quality.REFERENCE_WINDOW))


@register("ocr_quality_summary", SQL_QUALITY + f"""
SELECT count(*) AS total_files,
       count(*) FILTER (WHERE n_good::DOUBLE / n_tokens >= {quality.CUTOFF}) AS good_files,
       round_even(100 * (count(*) FILTER (WHERE n_good::DOUBLE / n_tokens >= {quality.CUTOFF}))::DOUBLE
                  / count(*), 1) AS pct_good
FROM sc
""")
def q_ocr_quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(_quality_scores(spark, sf))


# TXT-4 runs on raw text with a caller-supplied list; this fixed English list
# is the query parameter (case-sensitive, as in the reference).
STOPWORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he",
             "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were",
             "will", "with"]


@register("preprocess_tokens", f"""
WITH s AS (SELECT doc_id,
                  array_to_string(list_filter({split_ws('text')},
                                              lambda w: NOT list_contains([{", ".join(sql_str(w) for w in STOPWORDS)}], w)), ' ') AS f
           FROM documents),
t AS (SELECT doc_id, {sql_tokens('f')} AS t FROM s)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM t""")
def q_preprocess_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    toks = T.preprocess(F.col("text"), stopwords=STOPWORDS)
    return docs.select("doc_id", toks.alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register("simple_tokens", r"""
WITH t AS (SELECT doc_id,
                  list_filter(regexp_extract_all(lower(text), '([\pL\pM_]+)', 1),
                              lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_')) AS t
           FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM t""")
def q_simple_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", T.simple_tokens(F.col("text")).alias("t")).select(
        "doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))
