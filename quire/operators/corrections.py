"""Nonword correction (VEC-5, FLT-13, FLT-15/16, JN-10, JN-11, WIN-1) and
rewriting (TXT-15).

Derivation, once per *distinct* nonword (the reference recomputed it per
occurrence behind a cache):

  nonwords with a vector -> top-k most similar vocabulary words (exact kNN)
  -> similarity > threshold -> in the dictionary -> close enough in spelling
  -> the most similar survivor (ties by word).

The top-k is taken before the filters, as in the reference; filtering first
would change the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from . import knn
from .joins import lookup_join
from ..session import ship_package, stage

# Fixed values of the reference.
SIMILARITY_THRESHOLD = 0.6
LEVENSHTEIN_FRACTION = 0.3
TOP_K = 10


def close_enough(base, test, rounding: str = "half_even"):
    """FLT-15 / FLT-16: edit distance within 30% of the base word's length
    (banker's rounding, or ``floor`` for the stricter variant), or the base
    word contained in the candidate."""
    allowed = F.lit(LEVENSHTEIN_FRACTION) * F.length(base)
    allowed = F.floor(allowed) if rounding == "floor" else F.bround(allowed)
    return (F.levenshtein(base, test) <= allowed) | test.contains(base)


def corpus_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct normalised whitespace words of the corpus (empty ones dropped, D28)."""
    return docs.select(F.explode(T.tokenize(F.col(text))).alias("word")).distinct()


def derive_corrections(nonwords: DataFrame, word_vectors: DataFrame, dictionary: DataFrame,
                       threshold: float = SIMILARITY_THRESHOLD, k: int = TOP_K,
                       rounding: str = "half_even", **search) -> DataFrame:
    """VEC-5: ``(nonword, good_word, similarity)`` for the nonwords that have one.

    Only a word with a vector can be corrected, so the queries are the model's
    words among the nonwords: the model-sized table is the one that is searched,
    and ``nonwords(word)`` may be corpus-sized. ``search`` goes to the neighbour
    search, e.g. ``method="cells"`` for a large model."""
    wv = stage(word_vectors.select("word", "vector"), "word-vectors")
    queries = wv.join(nonwords.select("word"), "word", "left_semi")
    neighbors = knn.top_k_neighbors(queries.select(F.col("word").alias("id"), "vector"),
                                    wv.select(F.col("word").alias("id"), "vector"), k=k, **search)
    cand = (neighbors.where(F.col("sim") > F.lit(threshold))
            .join(dictionary.select(F.col("word").alias("cid")), "cid", "left_semi")
            .where(close_enough(F.col("qid"), F.col("cid"), rounding)))
    w = Window.partitionBy("qid").orderBy(F.col("sim").desc(), F.col("cid").asc())
    return (cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select(F.col("qid").alias("nonword"), F.col("cid").alias("good_word"),
                    F.col("sim").alias("similarity")))


def nonwords_of(docs: DataFrame, dictionary: DataFrame, text: str = "text") -> DataFrame:
    """Distinct corpus words that are not dictionary words."""
    return corpus_words(docs, text).join(dictionary.select("word"), "word", "left_anti")


def nonwords_of_vocabulary(frequencies: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same from a stored ``(word, tf, df)`` table: no pass over the corpus."""
    return frequencies.select("word").join(dictionary.select("word"), "word", "left_anti")


def word_map(dictionary: DataFrame, corrections: DataFrame) -> DataFrame:
    """``(word, out)``: dictionary words map to themselves, corrected nonwords
    to their replacement; anything else is absent (= dropped). A word in
    both keeps itself (dictionary first)."""
    keep = dictionary.select("word").distinct().select("word", F.col("word").alias("out"))
    fix = (corrections.select(F.col("nonword").alias("word"), F.col("good_word").alias("out"))
           .join(keep.select("word"), "word", "left_anti"))
    return keep.unionByName(fix)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, out)`` sorted by key, one row a word (null: none), to one text a key."""
    key, held = (), []  # of the key that may go on (none: ()), the words so far

    def batch_of(keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.string())], names=["key", "text"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, out = batch.columns
        code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        kept = np.concatenate([[0], np.cumsum(out.is_valid().to_numpy(zero_copy_only=False))])
        ends = kept[[*starts.tolist(), batch.num_rows]]
        words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), out.drop_null())
        texts, some = pc.binary_join(words, " ").to_pylist(), (np.diff(ends) > 0).tolist()
        keys = keys.take(pa.array(starts))
        if key and key[0] != keys[0].as_py():
            yield batch_of(pa.array(key, keys.type), [" ".join(held)])
            held = []
        held += texts[:1] if some[0] else []
        key = (keys[-1].as_py(),)
        if len(texts) > 1:
            yield batch_of(keys[:-1], [" ".join(held), *texts[1:-1]])
            held = texts[-1:] if some[-1] else []
    if key:
        yield batch_of(pa.array(key, keys.type), [" ".join(held)])


def replace_nonwords(docs: DataFrame, dictionary: DataFrame, corrections: DataFrame,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """TXT-15: per whitespace word, normalise; keep dictionary words, substitute
    corrected nonwords, drop the rest; re-join with spaces in text order.
    Documents with no surviving word become ''.

    The words that are left are sorted by document and place and joined from the
    stream, so that no list of a document's words is built on the way; a
    document's first word stays as a row, so that no document is lost."""
    ship_package(docs.sparkSession)
    words = docs.select(F.col(key).alias("key"), F.posexplode_outer(T.tokenize(F.col(text))).alias("pos", "word"))
    mapped = (lookup_join(words, word_map(dictionary, corrections), "word").select("key", "pos", "out")
              .where(F.col("out").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)))
    kind = docs.schema[key].dataType
    schema = ST.StructType([ST.StructField("key", kind), ST.StructField("text", ST.StringType())])
    placed = mapped.repartition("key").sortWithinPartitions("key", "pos", "out").select("key", "out")
    return placed.mapInArrow(_texts, schema).select(F.col("key").alias(key), F.col("text").alias(text))
