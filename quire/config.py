"""Job configuration (SRC-9, UDF-1..5).

The reference configures runs with Python modules of constants and
functions. Here the same knobs are frozen dataclasses passed to the jobs;
overridable steps are ``Column -> Column`` callables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import subspace, training, vocab

ColumnFn = Callable[[Column], Column]


@dataclass(frozen=True)
class CorpusConfig:
    """UDF-5: what a training run reads and how it preprocesses text."""

    identifier: str = "corpus"
    newspaper_dir: str | None = None             # read by ``documents``
    newspaper_dir_regex: str | None = None       # applied there (D10)
    results_dir: str | None = None
    min_frequency: int | None = None             # vocabulary keeps tf > this (default: minCount)
    epochs: int = 40                             # iterations of the subspace trainer
    trainer: str = "subspace"                    # or "indexing": one pass, no epochs
    vocabulary: str | None = None                # saved frequencies, AGG-13
    # TXT-4 list: "english" = Spark's built-in English list (the reference
    # always filtered stopwords first); None = no filter
    stopwords: tuple[str, ...] | str | None = "english"
    # D11: the reference removes stopwords before lower-casing and
    # depunctuating (so "The" survives); True removes them after tokenising
    stopwords_after_tokenize: bool = False
    stopword_filter: ColumnFn | None = None      # UDF-1
    tokenizer: ColumnFn | None = None            # UDF-2
    training_options: dict = field(default_factory=dict)   # UDF-3
    model_options: dict = field(default_factory=dict)      # UDF-4 (honoured, D9)

    def tokens(self, text: Column | str) -> Column:
        """TXT-5 with this configuration's overrides."""
        stop = self.stopwords
        if stop == "english":
            stop = T.default_stopwords(None)
        col = F.col(text) if isinstance(text, str) else text
        if self.stopwords_after_tokenize and stop and self.stopword_filter is None:
            return T.without_words((self.tokenizer or T.tokenize)(col), stop)
        return T.preprocess(col, stopwords=stop, stopword_filter=self.stopword_filter,
                            tokenizer=self.tokenizer)

    def documents(self, spark: SparkSession) -> DataFrame:
        """The configured corpus (SRC-3): pages and items with their kind."""
        from .sources import files
        return files.read_corpus(spark, self.newspaper_dir, self.results_dir, self.newspaper_dir_regex)

    def training_vocabulary(self, tokens: DataFrame, column: str = "tokens") -> DataFrame | None:
        """AGG-13: the words to train: saved frequencies if ``vocabulary`` names
        them, else those of ``tokens`` above ``min_frequency``; None leaves the
        choice to the trainer's ``minCount``."""
        if self.vocabulary:
            least = self.min_frequency or 0
            saved = tokens.sparkSession.read.parquet(self.vocabulary)
            return saved.where(F.col("tf") > least).select("word")
        if self.min_frequency is None:
            return None
        freq = vocab.word_frequencies(tokens, column)
        return freq.where(F.col("tf") > self.min_frequency).select("word")

    def train(self, tokens: DataFrame, column: str = "tokens") -> DataFrame:
        """VEC-1: ``(word, vector)`` by the configured trainer and options."""
        trainers = {"subspace": subspace.train_subspace, "indexing": training.train_distributed}
        if self.trainer not in trainers:
            raise ValueError(f"unknown trainer {self.trainer!r}")
        return trainers[self.trainer](tokens, self.model(), column, self.training_vocabulary(tokens, column))

    def document_vectors(self, word_vectors: DataFrame, tokens: DataFrame, key: str = "doc_id") -> DataFrame:
        """``(key, vector)`` of the documents for the trained words: inferred, or
        for "indexing" the mean of the unit word vectors."""
        size = self.model()["vectorSize"]
        if self.trainer == "indexing":
            return training.mean_vectors(word_vectors, tokens, key, size=size)
        return subspace.DocumentModel(word_vectors, size).infer(tokens, key)

    def model(self) -> dict:
        """Defaults, then epochs, then model and training overrides."""
        return training.model_options({"maxIter": self.epochs, **self.model_options, **self.training_options})

    def word2vec_options(self) -> dict:
        """The same for Spark's Word2Vec."""
        return self.model()


@dataclass(frozen=True)
class NewspaperSelection:
    """Newspaper part of a data set: titles, a year window and an optional
    limit on the number of batches (both may be given, unlike D5)."""

    lccns: tuple[str, ...] = ()
    first_year: int = 1865
    last_year: int = 1877
    count: int | None = None


@dataclass(frozen=True)
class DatasetDefinition:
    """SRC-9: which landed sources make up a data set. Each name is a
    sub-directory of the landing root holding that part's texts."""

    collections: tuple[str, ...] = ()
    date_filtered_collections: tuple[str, ...] = ()
    queries: tuple[str, ...] = ()
    items: tuple[str, ...] = ()
    newspapers: NewspaperSelection | None = None
    collection_years: tuple[int, int] = (1863, 1877)

    def parts(self) -> list[tuple[str, bool]]:
        """``(name, date_filtered)`` of every search-based part."""
        out = [(c, False) for c in self.collections]
        out += [(c, True) for c in self.date_filtered_collections]
        out += [(q, False) for q in self.queries]
        return out
