"""Keyword scoring of documents (VEC-6, TXT-16, JN-12, AGG-5, AGG-6, JN-16,
FLT-19).

score(doc, base) = bround(100 * sum of cos(w, base) over w in sample / n), where
the sample is the document's tokens of length >= 4 (all of them when
``fraction`` = 1, else a deterministic sample of bround(n*fraction)), a
word without a vector contributes 0, and n = 0 gives 0. The similarity of a
zero vector to anything is 0.

Plan shape: the keywords that the model knows are one aggregated row, read by a
scalar subquery; similarities are computed once per *vocabulary word* (one
projection over the word-vector table, no join). Document tokens are exploded
and joined to that table on the word (``joins.lookup_join``). Sums are over
fixed-point decimals, so their order never changes a score, and are
pre-aggregated map-side before the shuffle on doc id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from .joins import lookup_join

# Fixed values of the reference: sampling rate and minimum scored word length.
FRACTION = 0.1
MIN_WORD_LENGTH = 4

FIXED_POINT = "decimal(28,15)"


def base_vectors(word_vectors: DataFrame, base_words: Sequence[str]) -> DataFrame:
    """FLT-19: ``(word, v)`` of the requested keywords that the model knows, with
    unit vectors; one row per word (a word listed twice in the model takes the
    larger vector, compared element by element)."""
    words = list(dict.fromkeys(base_words))
    return (word_vectors.where(F.col("word").isin(*words))
            .select("word", F.col("vector").cast("array<double>").alias("v"))
            .groupBy("word").agg(F.max("v").alias("v"))
            .select("word", V.normalized("v").alias("v")))


def word_similarities(word_vectors: DataFrame, bases: DataFrame) -> DataFrame:
    """JN-12: ``(word, sims map<string,double>)`` -- cosine of every vocabulary
    word to each base word."""
    # as many elements as there are keywords: a parameter's size
    known = bases.agg(F.sort_array(F.collect_list(F.struct("word", "v"))).alias("b")).scalar()
    wv = word_vectors.groupBy("word").agg(F.max(F.col("vector").cast("array<double>")).alias("v"))
    wv = wv.select("word", "v", known.alias("b"))
    # the unit vector is bound once, not evaluated for each keyword
    sims = F.transform(F.array(V.normalized("v")),
                       lambda v: F.transform("b", lambda b: F.struct(b["word"], V.dot(v, b["v"]))))[0]
    return wv.select("word", F.map_from_entries(sims).alias("sims"))


def keyword_scores(docs: DataFrame, word_vectors: DataFrame, base_words: Sequence[str],
                   fraction: float = 1.0, seed: int = 0, key: str = "doc_id",
                   text: str = "text", tokenizer=T.tokenize) -> DataFrame:
    """AGG-5: ``(key, keyword_scores map<string,int>)`` for every document."""
    names = list(dict.fromkeys(base_words))
    if not names:
        return docs.select(key, F.create_map().cast("map<string,int>").alias("keyword_scores"))
    bases = base_vectors(word_vectors, names)
    found = bases.agg(F.collect_set("word").alias("w")).scalar()
    sims = word_similarities(word_vectors, bases)
    toks = T.long_tokens(tokenizer(F.col(text)), MIN_WORD_LENGTH)
    tokens = docs.select(key, toks.alias("_t"))
    if fraction < 1.0:
        tokens = tokens.select(key, T.sample_tokens("_t", fraction, seed, F.col(key), keep_order=False).alias("_t"))
    # the word count is taken before the explode so that the generator does
    # not carry the whole token array on every output row
    per_doc = (tokens.select(key, "_t", F.size("_t").alias("_n"))
               .select(key, "_n", F.explode_outer("_t").alias("word")))
    joined = lookup_join(per_doc, sims.select(
        "word", *[F.try_element_at("sims", F.lit(w)).cast(FIXED_POINT).alias(f"_c{i}") for i, w in enumerate(names)]),
        "word")
    sums = joined.groupBy(key).agg(
        F.max("_n").alias("_n"), *[F.sum(f"_c{i}").cast("double").alias(f"_s{i}") for i in range(len(names))])
    score = [F.when(F.col("_n") == 0, F.lit(0))
             .otherwise(F.bround(F.lit(100.0) * F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) / F.col("_n")).cast("int"))
             for i in range(len(names))]
    scores = F.map_from_arrays(F.array(*[F.lit(w) for w in names]), F.array(*score))
    return (sums.select(key, scores.alias("_all"), found.alias("_found"))
            .select(key, F.map_filter("_all", lambda w, _: F.array_contains("_found", w)).alias("keyword_scores")))


def scores_long(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, word, score)`` rows of a score map."""
    return scores.select(key, F.explode("keyword_scores").alias("word", "score"))


def score_ranges(scores: DataFrame) -> DataFrame:
    """AGG-6: per keyword, min seeded at 100 and max seeded at 0."""
    long = scores_long(scores)
    return long.groupBy("word").agg(
        F.least(F.lit(100), F.min("score")).alias("min_score"),
        F.greatest(F.lit(0), F.max("score")).alias("max_score"))


def upsert_scores(metadata: DataFrame, scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """JN-16: replace the whole ``keyword_scores`` map of records that have new
    scores; others keep theirs."""
    new = scores.select(key, F.col("keyword_scores").alias("_new"))
    out = metadata.join(new, key, "left")
    return out.withColumn("keyword_scores", F.coalesce("_new", "keyword_scores")).drop("_new")
