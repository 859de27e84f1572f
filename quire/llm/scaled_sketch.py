"""Document fingerprints: threshold-scaled sketches of word shingles.

A text's sketch holds the hash of every five-word shingle that lies below a
fixed fraction (1 / ``SCALE``) of the hash range, and at least its ``LEAST``
smallest hashes, so that short texts have a fingerprint too. The rule looks at
hash values only, so sketches merge: the sketch of a union of texts is the rule
applied to the union of their sketches. Two sketches are compared up to the hash
that both hold completely (the fraction, or the last hash of a short text's
sketch, or everything if the text has fewer than ``LEAST`` shingles): the common
hashes, divided by the smaller number, estimate how much of the smaller text the
other contains, whatever their sizes.

A shingle's hash is 48 bits: two sums modulo 2^31 - 1 of the halves of its
words' md5, weighted by place. Words are runs of characters other than ASCII
white space, with A-Z in lower case; a text of fewer than five words is one
shingle.

Scale. Sketches are one pass over whole texts, without a shuffle; merging is a
group-by on distinct hashes. ``against_next`` compares each text with its
neighbour in key order: the rows are dealt once, by key ranges whose bounds are
rows of a hash sample (``SAMPLE_ROWS`` a range; they set the sizes of the ranges
and nothing else), and the first row of each range also goes to the end of the
range before, so each task streams its own ranges and needs no other.

Edge cases: a null, empty or blank text has an empty sketch, which is like (1)
another empty one and unlike (0) any other; a very long text is sketched whole;
equal texts have equal sketches; repeated rows give a row each, and rows of equal
keys follow each other by hash and text, null keys last; a single row is its own
neighbour; no rows give no rows; columns besides key and text are ignored,
whatever their names, by ``against_next``, and kept by ``fingerprint``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_rows, quoted

SHINGLE_WORDS = 5
SCALE = 8
LEAST = 16
PRIME = (1 << 31) - 1
LOW_BITS = 17                       # of the second sum; the first has 31
PLACES = (1_103_515_245, 12_345_679, 1_664_525, 1_013_904_223, 69_069)  # weights of a shingle's places
SIZE_WEIGHT = 40_692                # weight of its number of words
FRACTION = (PRIME // SCALE) << LOW_BITS
WHOLE = np.iinfo(np.int64).max
CACHE_WORDS = 1 << 20               # words a worker remembers; beyond it starts afresh
RANGE_ROWS = 20_000                 # rows in one key range, about
MOST_RANGES = 100_000               # beyond it ranges grow instead
SAMPLE_ROWS = 16


class WordHash(dict):
    """word -> both 31-bit halves of its hash, as one number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        digest = hashlib.md5(word).digest()
        low, high = (int.from_bytes(x, "little") % PRIME for x in (digest[8:], digest[:8]))
        h = self[word] = low << 31 | high
        return h


def shingle_hashes(words: list[bytes], hashes: WordHash) -> np.ndarray:
    """The hash of each shingle, in text order."""
    size = min(SHINGLE_WORDS, len(words))
    if not size:
        return np.empty(0, np.int64)
    both = np.fromiter(map(hashes.__getitem__, words), dtype=np.int64, count=len(words))
    n = len(words) - size + 1
    sums = []
    for half in (both >> 31, both & PRIME):
        total = np.full(n, size * SIZE_WEIGHT, dtype=np.int64)
        for k in range(size):
            total += half[k:k + n] * PLACES[k] % PRIME
        sums.append(total % PRIME)
    return sums[0] << LOW_BITS | sums[1] & (1 << LOW_BITS) - 1


def retained(distinct: np.ndarray) -> np.ndarray:
    """The rule: of sorted distinct hashes those below the fraction, ``LEAST`` at least."""
    return distinct[:max(int(np.searchsorted(distinct, FRACTION)), LEAST)]


def sketch(text: str | None, hashes: WordHash) -> np.ndarray:
    """The sorted hashes of a text's sketch."""
    return retained(np.unique(shingle_hashes((text or "").encode("utf-8").lower().split(), hashes)))


def merged(sketches: list[np.ndarray]) -> np.ndarray:
    """The sketch of the union of the texts."""
    return retained(np.unique(np.concatenate(sketches)))


def complete_to(a: np.ndarray) -> int:
    """The largest hash up to which a sketch holds all hashes of its text."""
    if len(a) < LEAST:
        return WHOLE
    return max(FRACTION - 1, int(a[-1]))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller text's shingles that the other holds."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    most = min(complete_to(a), complete_to(b))
    a, b = a[:np.searchsorted(a, most, side="right")], b[:np.searchsorted(b, most, side="right")]
    least = min(len(a), len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least if least else 0.0


def hex_of(a: np.ndarray) -> str:
    """A sketch as text: 12 hexadecimal digits a hash."""
    raw = a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return raw.tobytes().hex()


# -- columns ------------------------------------------------------------------

def fingerprint(docs: DataFrame, text: str = "text") -> Column:
    """The sketch of ``text`` as an ``array<long>`` Column for ``docs``."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHash()
        for texts in batches:
            yield pd.Series([sketch(t, hashes) for t in texts])

    return F.pandas_udf(run, "array<long>").asNondeterministic()(F.col(quoted(text)))


def merge(sketches: DataFrame, group: str, column: str = "sketch") -> DataFrame:
    """``(group, sketch)``: the sketch of each group's texts together. Hashes are
    made distinct before the groups are gathered; a group's row is as long as its
    sketch. A null sketch, and a group without any hash, is the empty sketch."""
    of = sketches.select(F.col(quoted(group)).alias("g"), F.explode_outer(F.col(quoted(column))).alias("h")).distinct()
    low = of.where(F.col("h") < F.lit(FRACTION)).groupBy("g").agg(F.array_sort(F.collect_list("h")).alias("low"))
    # the LEAST smallest: cut inside parts of a group before the group itself
    part = of.groupBy("g", F.pmod(F.xxhash64("h"), F.lit(64)).alias("part")).agg(
        F.slice(F.array_sort(F.collect_list(F.when(F.col("h") >= F.lit(FRACTION), F.col("h")))), 1, LEAST).alias("some"))
    rest = part.groupBy("g").agg(F.array_sort(F.flatten(F.collect_list("some"))).alias("rest"))
    held = F.coalesce("low", F.array().cast("array<bigint>"))
    return (rest.join(low.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g")), "left")
            .select(F.col("g").alias(group), F.concat(held, F.slice(
                "rest", F.lit(1), F.greatest(F.lit(0), F.lit(LEAST) - F.size(held)))).alias(column)))


def containment(a: Column, b: Column) -> Column:
    """``likeness`` of two sketch columns."""
    last = lambda x: F.when(F.size(x) < LEAST, F.lit(WHOLE)).otherwise(
        F.greatest(F.lit(FRACTION - 1), F.array_max(x)))
    most = F.least(last(a), last(b))
    up_to = lambda x: F.filter(x, lambda h: h <= most)
    least = F.least(F.size(up_to(a)), F.size(up_to(b)))
    share = F.when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(up_to(a), up_to(b))) / least)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(share)


# -- neighbours in key order -----------------------------------------------------

ORDER = ["none", "down", "hash"]  # null keys last, descending key, then the text's hash


def key_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    k, t = F.col(quoted(key)).cast("long"), F.coalesce(F.col(quoted(text)), F.lit(""))
    return docs.select(F.col(quoted(key)).alias("key"), t.alias("text"),
                       F.when(k.isNull(), 1).otherwise(0).cast("long").alias("none"),
                       F.bitwise_not(F.coalesce(k, F.lit(0))).alias("down"), F.xxhash64(t).alias("hash"))


def range_starts(rows: DataFrame, spark: SparkSession) -> list[tuple[int, int, int]]:
    """The places in the order at which ranges start, each that of a row; the
    first is the first row's."""
    place = F.struct(*ORDER)
    n, first = rows.agg(F.count(F.lit(1)), F.min(place)).first()
    if not n:
        return []
    ranges = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // RANGE_ROWS)))
    share = min(1.0, SAMPLE_ROWS * ranges / n)
    picked = F.pmod(F.xxhash64(*ORDER, F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = sorted({tuple(r) for r in rows.where(picked).select(*ORDER).collect()})  # about SAMPLE_ROWS a range
    cuts = {sample[len(sample) * i // ranges] for i in range(1, ranges)} if sample else set()
    return sorted(cuts | {tuple(first)})


def in_ranges(rows: DataFrame, starts: list[tuple[int, int, int]]) -> DataFrame:
    """The rows by range and order. A range's first row stands once more at the
    end of the range before (the first range's after the last)."""
    kind = [(c, "<i8") for c in ORDER]
    bounds = np.array(starts, dtype=kind)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for cols in batches:
            place = np.empty(len(cols[0]), dtype=kind)
            for c, values in zip(ORDER, cols):
                place[c] = values.to_numpy()
            at = np.searchsorted(bounds, place, side="right") - 1
            yield pd.DataFrame({"at": at, "starts": bounds[at] == place})

    at = F.pandas_udf(run, "at int, starts boolean").asNondeterministic()(*ORDER)
    n = len(starts)
    here = F.struct(F.col("place.at").alias("at"), F.lit(0).alias("last"))
    before = F.struct(F.pmod(F.col("place.at") - 1, F.lit(n)).cast("int").alias("at"), F.lit(1).alias("last"))
    dealt = (rows.withColumn("place", at)
             .withColumn("copy", F.explode(F.when(F.col("place.starts"), F.array(here, before)).otherwise(F.array(here))))
             .select(F.col("copy.at").alias("at"), F.col("copy.last").alias("last"), "key", "text", *ORDER))
    # each range is a partition of its own
    return dealt.repartitionById(n, F.col("at")).sortWithinPartitions("at", "last", *ORDER, "text")


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, compared with an edited text and with the next
    row's in descending order of the (integer) key; after the last comes the
    first. The edited text is the text with its last floor(n_chars / 2)
    characters replaced by the first as many of the next text.

    ``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_hashes)``."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = key_order(docs, key, text)
    starts = range_starts(rows, spark)
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_hashes"]
    kind = rows.schema["key"].dataType.simpleString()
    schema = (f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, n_hashes long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        before = None  # (range, key, text, sketch) of the row that waits for its next
        for batch in batches:
            out = []
            for at, last, k, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last and before is None:
                    continue  # one more row of the same place
                mine = sketch(t, hashes)
                if before is not None:
                    out.append(compared(*before, t, mine, hashes))
                before = None if last else (k, t, mine)
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], batch.column(2).type), *[pa.array(c) for c in cols[1:]]], names=names)

    if not starts:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    dealt = in_ranges(rows, starts).select("at", "last", "key", "text")
    return map_rows(dealt, task, schema).withColumnRenamed("key", key)


def compared(key, text: str, mine: np.ndarray, following: str, its: np.ndarray, hashes: WordHash) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    changed = sketch(edited, hashes)
    return (key, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), hex_of(mine), hex_of(changed),
            likeness(mine, changed), likeness(mine, its), len(mine))
