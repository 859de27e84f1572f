"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target
against the raw corpus, after a few fixed base rules.

Words are runs of characters other than ASCII white space. Every word and every
pair of neighbouring words is hashed into one of ``BUCKETS`` buckets. Two
multinomials are counted over all documents: the raw corpus, and the documents
that the labels trust (the raw one, scaled to the target's size, is also the
prior of the target, with ``PRIOR_SHARE`` times the target's n-grams spread
evenly over the buckets as pseudo-counts). A text's score is the sum of
log(target / raw) over its n-grams divided by their number.

The threshold is read off trusted texts that were not counted: a fold of them
(``FOLDS``) is left out of the target and scored like any unlabelled text. With
the one-percent quantile and the median of those that pass the base rules, the
threshold lies as far below the quantile as the quantile lies below the median.
Neither the prior nor the threshold knows the size of the corpus: the same rows
ten times over give the same verdicts. On a small corpus most n-grams of any
text are its own, so the classes overlap, but the threshold moves with them.
Log ratios are rounded to whole millionths and the fold's scores to whole
thousandths, so sums and quantiles are integers: every run, in any order, gives
the same verdict.

Scale. One pass over the texts writes the base statistics and each text's bag of
buckets, packed to about a quarter of the text; counts, the fold's scores and all
scores are taken from it. Counting is a map-side sum into fixed arrays of
``BUCKETS`` cells; only those cells are shuffled and sent on, whatever the size
of the corpus, and a thousandth-wide histogram of the fold's scores. Trusted
documents are found by a join on the key that moves the packed bags, not the
texts.

Edge cases: a null, empty or blank text has no words and fails the base rules;
labels of unknown documents and null labels are ignored; a document labelled
more than once is trusted if any label trusts it; with no trusted documents every
ratio is 0, and without a trusted text in the fold that passes the base rules
there is no threshold: then only the base rules decide. Other columns of the
documents may have any name; ``filter_documents`` returns them as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, stage
from .common import map_rows, packed_row, quoted, unpacked_row

BUCKETS = 1 << 16
PRIME = 1_000_003         # word hashes are below this
PAIR_A, PAIR_B = 31_337, 7
PRIOR_SHARE = 2           # pseudo-counts that draw the ratios to 1, as a share of the target
MICRO, MILLI = 1_000_000, 1_000
FOLDS = 5                 # one of them sets the threshold
LOW_PERCENT, MIDDLE_PERCENT = 1, 50
MIN_WORDS = 50
MAX_REPEATED = 50         # percent of words inside repeated 3-word windows
CACHE_WORDS = 1 << 20     # words a worker remembers; beyond it starts afresh
SYMBOLS = b"#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


class WordHash(dict):
    """word -> hash below ``PRIME``, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.md5(word).digest()[8:], "little") % PRIME
        return h


def buckets(found: list[bytes], hashes: WordHash) -> np.ndarray:
    """The buckets of a text's words and word pairs."""
    h = np.fromiter(map(hashes.__getitem__, found), dtype=np.int64, count=len(found))
    pairs = (h[:-1] * PAIR_A + h[1:] * PAIR_B) % PRIME
    return np.concatenate([h, pairs]) % BUCKETS


def packed(grams: np.ndarray) -> bytes:
    """Buckets as sorted differences, low bytes first, then (mostly zero) high
    bytes, compressed: less than a byte a gram."""
    grams = np.sort(grams.astype(np.uint16))
    steps = np.diff(grams, prepend=np.uint16(0)).astype("<u2")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    data = zstandard.decompress(data) if data else data
    steps = np.frombuffer(data, dtype=np.uint8).reshape(2, -1).T.copy().view("<u2").ravel()
    return np.cumsum(steps, dtype=np.int64)


def repeated_words(found: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds at least twice."""
    if len(found) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in found], dtype=np.int64)
    size = len(number)
    pairs = ids[:-1] * size + ids[1:]
    if size > 1 << 20:  # keep the window code below 2^63
        _, pairs = np.unique(pairs, return_inverse=True)
    _, at, times = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(times[at] > 1)
    hit = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        hit[twice + k] = True
    return int(hit.sum())


def base_stats(text: str, raw: bytes, found: list[bytes]) -> tuple:
    """The columns of ``STATS``."""
    n = len(found)
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeats = repeated_words(found)
    return (n, chars, symbols, len(lines) - len(set(lines)), repeats,
            n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n)


class Model(NamedTuple):
    """Log ratios of the buckets in whole millionths, and the thousandths a text's
    mean must reach (None: no threshold)."""
    ratios: np.ndarray
    threshold: int | None


def measured(docs: DataFrame, key: str, text: str, keep_rows: bool) -> DataFrame:
    """``(key, STATS, grams)`` of each document, with its whole row if asked,
    staged. ``grams`` is the text's packed bag of buckets."""
    ship_package(docs.sparkSession)
    names = [part.split()[0] for part in STATS.split(",")]
    kind = ", ".join(":".join(p.split()) for p in STATS.split(","))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for texts in batches:
            rows = []
            for t in texts:
                t = t or ""
                raw = t.encode("utf-8")
                found = raw.split()
                rows.append((*base_stats(t, raw, found), packed(buckets(found, hashes)) if found else b""))
            yield pd.DataFrame(rows, columns=[*names, "grams"])

    found = F.pandas_udf(run, f"struct<{kind}, grams:binary>").asNondeterministic()(F.col("text"))
    rows = packed_row(docs, key=key, text=text)
    return stage(rows.select("key", *(["row"] if keep_rows else []), found.alias("found"))
                 .select("key", *(["row"] if keep_rows else []), "found.*"), "quality-grams")


def in_fold(key: Column) -> Column:
    """The fold of keys whose trusted texts set the threshold."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % FOLDS == 0


def bucket_counts(vectors: DataFrame) -> DataFrame:
    """``(bucket, n)``: n-grams of all texts per bucket."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for grams in batch.column(0).to_pylist():
                np.add.at(total, unpacked(grams), 1)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return (map_rows(vectors.select("grams"), task, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def llr_column(ratios: np.ndarray, spark: SparkSession) -> Column:
    """The sum of the log ratios of packed ``grams``, in millionths."""
    sent = spark.sparkContext.broadcast(ratios)  # BUCKETS numbers

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for bags in batches:
            yield pd.Series([int(sent.value[unpacked(g)].sum()) if g else 0 for g in bags], dtype="int64")

    return F.pandas_udf(run, "long").asNondeterministic()(F.col("grams"))


def quantile(histogram: list[tuple[int, int]], percent: int) -> int:
    """The least value that ``percent`` of the (value, count) pairs do not exceed."""
    total, seen = sum(n for _, n in histogram), 0
    for value, n in sorted(histogram):
        seen += n
        if 100 * seen >= percent * total:
            return value
    raise ValueError("an empty histogram has no quantiles")


def fit(found: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """The model of ``measured`` documents. What reaches the driver is one row per
    bucket, and one per thousandth of the fold's scores."""
    keys = labels.where(F.col(quoted(label)) == 1).select(F.col(quoted(key)).alias("key")).distinct()
    # always a join by key: the same plan at every size, with only the packed bags moved
    trusted = stage(found.select("key", "n_words", "base_failed", "grams").hint("merge").join(keys, "key", "left_semi"),
                    "quality-trusted")
    counts = []
    for part in (found, trusted.where(~in_fold(F.col("key")))):
        total = np.zeros(BUCKETS)
        for row in bucket_counts(part).collect():
            total[row["bucket"]] = row["n"]
        counts.append(total)
    raw, target = counts
    if not target.any():
        return Model(np.zeros(BUCKETS, dtype=np.int64), None)
    prior = PRIOR_SHARE * target.sum() / BUCKETS
    ratios = np.rint(MICRO * np.log((target + prior) / (raw * (target.sum() / raw.sum()) + prior))).astype(np.int64)
    fold = trusted.where(in_fold(F.col("key")) & ~F.col("base_failed"))
    mean = F.floor(llr_column(ratios, found.sparkSession) / (MICRO // MILLI * n_grams()))
    scores = [(r["mean"], r["n"]) for r in fold.groupBy(mean.alias("mean")).agg(F.count(F.lit(1)).alias("n")).collect()]
    if not scores:
        return Model(ratios, None)
    return Model(ratios, 2 * quantile(scores, LOW_PERCENT) - quantile(scores, MIDDLE_PERCENT))


def n_grams() -> Column:
    return 2 * F.col("n_words") - 1


def judged(found: DataFrame, model: Model) -> DataFrame:
    """``measured`` documents with ``llr_micro`` (the sum of the n-grams' log ratios
    in millionths) and ``kept``, without their grams."""
    scored = found.withColumn("llr_micro", llr_column(model.ratios, found.sparkSession)).drop("grams")
    if model.threshold is None:
        return scored.withColumn("kept", ~F.col("base_failed"))
    least = F.lit(model.threshold * (MICRO // MILLI))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr_micro") >= least * n_grams()))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality") -> DataFrame:
    """``(key, STATS, llr_micro, kept)`` of every document."""
    found = measured(docs, key, text, keep_rows=False)
    return judged(found, fit(found, labels, key, label)).withColumnRenamed("key", key)


def filter_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                     label: str = "quality") -> DataFrame:
    """``docs`` that the rules keep, with their own columns."""
    found = measured(docs, key, text, keep_rows=True)
    kept = judged(found, fit(found, labels, key, label)).where("kept")
    return unpacked_row(kept, docs.columns)
