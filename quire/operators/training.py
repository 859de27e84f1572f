"""Training word and document vectors (VEC-1, SNK-6, SNK-7, SRC-11, UDF-3/4).

The reference trains gensim's PV-DM Doc2Vec on one machine. Two trainers fill
its role here; numbers differ from PV-DM, and every downstream step takes the
vectors as an input table, so any source works.

* ``train_distributed`` (default): random indexing. Every word has a fixed
  random +-1 signature (bits of its md5); a word's vector is the sum of the
  signatures of the words around it, over all its occurrences. It is one
  aggregation with map-side combine: nothing but the vocabulary table itself
  grows with the vocabulary, nothing passes through the driver, sums of whole
  numbers are exact, and one pass over the corpus is all there is (no epochs).
* ``train``: ``pyspark.ml.feature.Word2Vec``, which keeps the vocabulary and
  the vector matrix on the driver and broadcasts them; for vocabularies that a
  driver can hold (``minCount`` bounds them).

A document vector is the mean of its word vectors. A document without any word
of the model has the zero vector.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stage
from . import dealt
from .dealt import flat_words
from .joins import lookup_join

# Reference defaults: 50 dimensions, words seen at least 25 times, 40 epochs.
MODEL_DEFAULTS = {
    "vectorSize": 50,
    "minCount": 25,
    "maxIter": 40,
    "windowSize": 5,
    "stepSize": 0.025,
    "seed": 42,
}

HELD_WORDS = 150_000    # words whose sums a task holds
STEP_WORDS = 1 << 15    # places that a task widens to vectors at once

# bit of an md5 byte that each dimension takes: hex digits in order, low bits first
_BITS = np.array([4, 5, 6, 7, 0, 1, 2, 3], np.uint8)


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as an Arrow column of lists."""
    flat = pa.array(rows.ravel())
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(flat.type))


def model_options(overrides: dict | None = None) -> dict:
    """UDF-3/4: caller options merged over the defaults (honoured, unlike D9)."""
    return {**MODEL_DEFAULTS, **(overrides or {})}


def signature(word, size: int) -> list:
    """``size`` columns of +-1: bits of the md5 of the word (128 a hash; more
    dimensions hash the word again with a number)."""
    out = []
    for d in range(size):
        block, bit = divmod(d, 128)
        h = F.md5(F.concat(F.lit(f"{block}/"), word).cast("binary"))
        nibble = F.conv(F.substring(h, bit // 4 + 1, 1), 16, 10).cast("int")
        out.append(F.shiftright(nibble, bit % 4).bitwiseAND(F.lit(1)) * 2 - 1)
    return out


def signatures(words: list, size: int) -> np.ndarray:
    """The same as rows of a matrix."""
    blocks = range(-(-size // 128))
    md5 = b"".join(hashlib.md5(f"{k}/{w}".encode(), usedforsecurity=False).digest() for w in words for k in blocks)
    octets = np.frombuffer(md5, np.uint8).reshape(len(words), -1)
    bits = np.repeat(octets, 8, axis=1)[:, :size] >> np.resize(_BITS, size) & 1
    return bits.astype(np.int8) * 2 - 1


class ContextSums:
    """Sums of the signatures around words, for the words that a task has met."""

    def __init__(self, size: int, window: int):
        self.size, self.window = size, window
        self.clear()

    def clear(self) -> None:
        self.at: dict = {}
        self.signs, self.total = np.zeros((0, self.size), np.int8), np.zeros((0, self.size), np.int64)

    def places(self, words: list) -> np.ndarray:
        """The rows of ``words``; new ones are added (null has signature 0)."""
        first = len(self.at)
        at = np.array([self.at.setdefault(w, len(self.at)) for w in words], np.int64)
        if len(self.at) > len(self.total):
            more = np.zeros((max(len(self.at), 2 * len(self.total)) - len(self.total), self.size), np.int64)
            self.total = np.concatenate([self.total, more])
            self.signs = np.concatenate([self.signs, more.astype(np.int8)])
        new = [(i, w) for i, w in zip(at.tolist(), words) if i >= first and w is not None]
        if new:
            self.signs[[i for i, _ in new]] = signatures([w for _, w in new], self.size)
        return at

    def add(self, flat: pa.Array, starts: np.ndarray, ends: np.ndarray, a: int, b: int) -> None:
        """Take in the places ``a`` to ``b`` of the words ``flat``; each one's document
        has the places ``starts`` to ``ends``."""
        left, right = max(0, a - self.window), min(len(flat), b + self.window)
        coded = flat.slice(left, right - left).dictionary_encode(null_encoding="encode")
        index = coded.indices.to_numpy(zero_copy_only=False)
        at = self.places(coded.dictionary.to_pylist())
        # dimensions are rows here: running sums and differences go along memory
        rows = np.take(np.ascontiguousarray(self.signs[at].T), index, axis=1)
        running = np.zeros((self.size, len(index) + 1), np.int32)
        np.cumsum(rows, axis=1, out=running[:, 1:])
        place = np.arange(a, b)
        first, last = np.maximum(place - self.window, starts[a:b]), np.minimum(place + self.window + 1, ends[a:b])
        around = np.take(running, last - left, axis=1) - np.take(running, first - left, axis=1) - rows[:, a - left:b - left]
        index = index[a - left:b - left]
        order = np.argsort(index, kind="stable")
        cuts = np.flatnonzero(np.diff(index[order], prepend=-1))
        sums = np.add.reduceat(np.take(around, order, axis=1), cuts, axis=1, dtype=np.int64)
        self.total[at[index[order][cuts]]] += sums.T

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``(word, small, large)``: the sums as bytes where all of them are so small
        (most words are rare), else as long numbers."""
        words = np.array(list(self.at), dtype=object)
        known = np.array([w is not None for w in words], bool)
        small = (np.abs(self.total[:len(words)]) < 128).all(axis=1)
        for some, others in ((small, False), (~small, True)):
            picked = np.flatnonzero(some & known)
            for at in range(0, len(picked), 4096):
                part = picked[at:at + 4096]
                sums = self.total[part]
                none = [pa.nulls(len(part), pa.list_(kind)) for kind in (pa.int8(), pa.int64())]
                none[others] = _lists(sums if others else sums.astype(np.int8))
                yield pa.RecordBatch.from_arrays([pa.array(words[part].tolist(), pa.string()), *none], names=["word", "small", "large"])


def context_sums(tokens: DataFrame, size: int, window: int) -> DataFrame:
    """``(word, small array<byte>, large array<long>)``, one row or more a word: sums of
    the signatures of the words around it. Tasks add up by word before anything is
    shuffled, and hold about ``HELD_WORDS`` words."""
    ship_package(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = ContextSums(size, window)
        for batch in batches:
            flat, doc = flat_words(batch.column(0))
            lengths = np.bincount(doc, minlength=batch.num_rows)
            ends = np.cumsum(lengths)
            starts, ends = (ends - lengths)[doc], ends[doc]
            for a in range(0, len(doc), STEP_WORDS):
                held.add(flat, starts, ends, a, min(a + STEP_WORDS, len(doc)))
                if len(held.at) >= HELD_WORDS:
                    yield from held.rows()
                    held.clear()
        yield from held.rows()

    return tokens.mapInArrow(run, "word string, small array<byte>, large array<long>")


def train_distributed(tokens: DataFrame, options: dict | None = None, tokens_col: str = "tokens",
                      vocabulary: DataFrame | None = None) -> DataFrame:
    """VEC-1: ``(word, vector array<long>)`` of the words seen at least
    ``minCount`` times (or of the given ``vocabulary(word)``), by random indexing
    over ``windowSize`` words on either side.

    A task sums the signatures around its own words; only sums, one row a task and
    word, are shuffled."""
    opts = model_options(options)
    size, window = opts["vectorSize"], opts["windowSize"]
    toks = tokens.select(F.col(tokens_col).alias("t"))
    if vocabulary is None:
        vocabulary = (toks.select(F.explode("t").alias("word")).groupBy("word")
                      .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= opts["minCount"]))
    vocabulary = stage(vocabulary.select("word"), "vocabulary")
    known = lookup_join(context_sums(toks, size, window), vocabulary, "word", "left_semi", stored=True)
    sums = known.groupBy("word").agg(*[F.sum(F.coalesce(F.col("small")[d].cast("long"), F.col("large")[d])).alias(f"_d{d}")
                                       for d in range(size)])
    return (vocabulary.join(sums, "word", "left")
            .select("word", F.array(*[F.coalesce(F.col(f"_d{d}"), F.lit(0)) for d in range(size)]).alias("vector")))


FIXED = 10 ** 15     # a unit vector's elements are counted in these parts
_LOW = 20            # bits summed apart, so that no sum leaves 64 bits


def mean_vectors(word_vectors: DataFrame, tokens: DataFrame, key: str = "doc_id",
                 tokens_col: str = "tokens", size: int = MODEL_DEFAULTS["vectorSize"]) -> DataFrame:
    """``(key, vector array<double>)``: mean of the unit vectors of a document's
    known words, zero without any. Sums are fixed-point, so their order does not
    matter. Documents meet the vectors of their words in blocks (``dealt``)."""
    from ..functions import vectors as V
    v = word_vectors.select("word", F.col("vector").cast("array<double>").alias("v"))
    unit = v.select("word", V.unit("v", V.norm("v")).alias("v")).where("v IS NOT NULL")
    # a word that the model has twice counts twice
    fixed = unit.groupBy("word").agg(F.count(F.lit(1)).alias("_n"), *[
        F.sum((F.col("v")[d].cast("decimal(17,15)") * FIXED).cast("long")).alias(f"_v{d}") for d in range(size)]).select(
        "word", F.array("_n", *[F.coalesce(f"_v{d}", F.lit(0)) for d in range(size)]).alias("value"))

    def summed(keys: int, run: np.ndarray, row: np.ndarray, n: np.ndarray, values: np.ndarray) -> list[pa.Array]:
        if not len(row):
            return [_lists(np.zeros((keys, size)))]
        found = values[row, 1:]
        high, low = (dealt.run_sums(run, x * n[:, None], keys) for x in (found >> _LOW, found & (1 << _LOW) - 1))
        total = high.astype(np.longdouble) * (1 << _LOW) + low
        known = np.bincount(run, n * values[row, 0], keys)[:, None]
        return [_lists(np.where(known > 0, (total / FIXED).astype(float) / np.maximum(known, 1), 0.0))]

    kind = tokens.schema[key].dataType.simpleString()
    return dealt.by_key(tokens, stage(fixed, "unit-vectors"), key, tokens_col, summed,
                        f"`{key}` {kind}, vector array<double>", [key, "vector"])


def train(tokens: DataFrame, options: dict | None = None, tokens_col: str = "tokens",
          num_partitions: int | None = None) -> Word2VecModel:
    """VEC-1 with Spark's Word2Vec (vocabulary on the driver). Sentences are
    whole documents: the longest sets ``maxSentenceLength``."""
    opts = model_options(options)
    toks = tokens.select(tokens_col)
    if "maxSentenceLength" not in opts:
        opts["maxSentenceLength"] = max(1, toks.agg(F.max(F.size(tokens_col))).first()[0] or 1)
    if num_partitions is None:
        num_partitions = tokens.sparkSession.sparkContext.defaultParallelism
    return Word2Vec(inputCol=tokens_col, outputCol="vector", numPartitions=num_partitions, **opts).fit(toks)


def word_vectors(model: Word2VecModel) -> DataFrame:
    """``(word, vector array<float>)`` of a trained model."""
    return model.getVectors().select("word", vector_to_array("vector", "float32").alias("vector"))


def doc_vectors(model: Word2VecModel, tokens: DataFrame, key: str = "doc_id",
                tokens_col: str = "tokens") -> DataFrame:
    """``(key, vector array<float>)``: mean word vector of each document."""
    out = model.transform(tokens.select(key, tokens_col))
    return out.select(key, vector_to_array("vector", "float32").alias("vector"))


def model_id(identifier: str) -> str:
    """SNK-6: model identifier plus a timestamp."""
    return f"{identifier}-{time.strftime('%Y%m%d-%H%M%S')}"


def save(model: Word2VecModel, path: str, tokens: DataFrame | None = None, key: str = "doc_id") -> None:
    """SNK-6 / SNK-7: the Spark model plus parquet tables of word (and
    document) vectors, so later stages read vectors as plain tables."""
    model.write().overwrite().save(f"{path}/model")
    word_vectors(model).write.mode("overwrite").parquet(f"{path}/word_vectors")
    if tokens is not None:
        doc_vectors(model, tokens, key).write.mode("overwrite").parquet(f"{path}/doc_vectors")


def save_tables(path: str, vectors: DataFrame, documents: DataFrame | None = None) -> None:
    """SNK-6 / SNK-7 for vectors that are tables already."""
    vectors.write.mode("overwrite").parquet(f"{path}/word_vectors")
    if documents is not None:
        documents.write.mode("overwrite").parquet(f"{path}/doc_vectors")


def load_word_vectors(spark, path: str) -> DataFrame:
    """SRC-11: vectors saved by ``save`` (or any ``(word, vector)`` table)."""
    return spark.read.parquet(f"{path}/word_vectors")


def load_model(path: str) -> Word2VecModel:
    return Word2VecModel.load(f"{path}/model")
