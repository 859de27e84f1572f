"""OCR quality filter (FLT-2, TXT-18) and its yield summary (AGG-10, FN-24).

Per document: the tokens longer than ``min_word_length``, made distinct;
score = share found in the dictionary; keep iff score >= cutoff. Whole texts
are judged; ``words_to_examine=REFERENCE_WINDOW`` looks at the first 400 tokens
only, as the reference does. A document without any long token is dropped and
is not counted in the totals.

Plan shape: the distinct tokens of a document are exploded and looked up in the
dictionary (``joins.lookup_join``); the per-document counts are pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokenize
from .joins import lookup_join

# Fixed values of the reference filter.
CUTOFF = 0.57
REFERENCE_WINDOW = 400
MIN_WORD_LENGTH = 3  # tokens must be strictly longer


def examined_tokens(text, words_to_examine: int | None = None,
                    min_word_length: int = MIN_WORD_LENGTH, tokenizer=tokenize):
    """TXT-18 + FLT-17 + AGG-14: distinct long tokens (among the first N if given)."""
    toks = tokenizer(text)
    window = toks if words_to_examine is None else F.slice(toks, 1, words_to_examine)
    return F.filter(F.array_distinct(window), lambda w: F.length(w) > min_word_length)


def quality_scores(documents: DataFrame, dictionary: DataFrame, key: str = "doc_id",
                   text: str = "text", stored: bool = False, **kw) -> DataFrame:
    """``(key, n_tokens, n_good, score)`` for every document with long tokens.
    ``stored``: ``dictionary`` is a stored table of distinct words."""
    words = documents.select(key, F.explode(examined_tokens(F.col(text), **kw)).alias("word"))
    dic = dictionary.select("word") if stored else dictionary.select("word").distinct()
    joined = lookup_join(words, dic.withColumn("_in_dict", F.lit(1)), "word", stored=stored)
    return (joined.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_tokens"),
                 F.count(F.col("_in_dict")).alias("n_good"))
            .withColumn("score", F.col("n_good") / F.col("n_tokens")))


def quality_filter(documents: DataFrame, dictionary: DataFrame, cutoff: float = CUTOFF,
                   key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """FLT-2: the documents that pass, with their scores."""
    scores = quality_scores(documents, dictionary, key=key, text=text, **kw)
    return scores.where(F.col("score") >= F.lit(cutoff))


def quality_summary(scores: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """AGG-10: good / total / percent (one decimal, half-even) in one pass."""
    good = F.count_if(F.col("score") >= F.lit(cutoff))
    total = F.count(F.lit(1))
    return scores.agg(
        total.alias("total_files"),
        good.alias("good_files"),
        F.bround(F.try_divide(good * F.lit(100.0), total), 1).alias("pct_good"),
    )
