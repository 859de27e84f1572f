"""Documents as lists of word numbers, without a copy of the vocabulary in any task.

A task reads documents in segments of about ``SEGMENT_WORDS`` running words, gives
each distinct word of a segment a number of its own and stores the documents as such
numbers, beside the list of the segment's words. Only that list is joined with the
lookup table of word numbers (by the planner's choice); then a segment's documents
and the numbers of its words meet in one task. A token costs a few bytes from then on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import remove_stages, ship_package, stage_packed, stage_scope
from .dealt import flat_words

SEGMENT_WORDS = 4_000_000   # running words of a segment, about

STRIP_WORDS = 40_000        # words that a strip of the vocabulary has on average, at most
CHUNK_WORDS = 4096          # words of a strip that are stored in one row
PLACES = 1 << 17            # places that numbers leave to a strip


def strips(vocabulary: DataFrame, number: int) -> DataFrame:
    """``(strip, chunk, words array<string>)``: the distinct words of
    ``vocabulary(word)`` dealt over ``number`` strips by hash, sorted. Nulls are left out."""
    ship_package(vocabulary.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunk, held = None, 0, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([chunk], pa.int32()), pa.array([held], pa.list_(pa.string()))],
                                              names=["strip", "chunk", "words"])

        for batch in batches:
            for strip, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (strip != at or len(held) == CHUNK_WORDS):
                    yield row()
                    chunk, held = chunk + 1 if strip == at else 0, []
                at = strip
                held.append(word)
        if held:
            yield row()

    strip = F.pmod(F.xxhash64("word"), F.lit(number)).cast("int").alias("strip")
    dealt = (vocabulary.where("word IS NOT NULL").select(strip, "word").distinct()
             .repartitionById(number, F.col("strip")).sortWithinPartitions("strip", "word"))
    return dealt.mapInArrow(run, "strip int, chunk int, words array<string>")


def numbers(stored: DataFrame) -> DataFrame:
    """``(word, id int)`` of the words of stored ``strips``: the strip in the high bits,
    the place in it in the low ones."""
    return (stored.select("strip", "chunk", F.posexplode("words").alias("at", "word"))
            .select("word", (F.col("strip") * PLACES + F.col("chunk") * CHUNK_WORDS + F.col("at")).alias("id")))


def documents(tokens: DataFrame, lookup: DataFrame, key: str, tokens_col: str) -> DataFrame:
    """``(key, ids array<int>)``, stored, one row for each row of ``tokens``: the number
    of each token in ``lookup(word, id)``, -1 for others. A null list is empty."""
    spark = tokens.sparkSession
    ship_package(spark)
    kind = tokens.schema[key].dataType
    arrow = to_arrow_type(kind)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        segment, at, running = (context.partitionId() if context else 0) << 32, {}, 0

        def words() -> pa.RecordBatch:
            n = len(at)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, segment)), pa.nulls(n, arrow), pa.nulls(n, pa.list_(pa.int32())),
                                               pa.array(np.arange(n, dtype=np.int32)), pa.array(list(at), pa.string())], names=names)

        for batch in batches:
            flat, doc = flat_words(batch.column(1))
            coded = flat.dictionary_encode()
            place = np.array([*(at.setdefault(w, len(at)) for w in coded.dictionary.to_pylist()), -1], np.int32)
            codes = place[coded.indices.fill_null(len(place) - 1).to_numpy(zero_copy_only=False)]
            ends = np.cumsum(np.bincount(doc, minlength=batch.num_rows)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(1, np.int32), ends])), pa.array(codes))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, segment)), batch.column(0), lists, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())],
                                             names=names)
            running += len(codes)
            if running >= SEGMENT_WORDS:
                yield words()
                segment, at, running = segment + 1, {}, 0
        yield words()

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, table = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(i).to_numpy() for i in range(2)])
            cuts = (np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                part, (segment, side) = batch.slice(a, b - a), place[:, a].tolist()
                if segment != at:
                    at, held, table = segment, [], None
                if side == 0:
                    held.append([part.column(i).to_numpy() for i in (4, 5)])
                    continue
                if table is None:
                    places, ids = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, int), np.zeros(0, int))
                    table = np.full(places.max(initial=-1) + 2, -1, np.int32)  # the last is for words without a number
                    table[places] = ids
                codes = part.column(3).flatten().to_numpy()
                lengths = part.column(3).value_lengths().to_numpy()
                ends = np.cumsum(lengths).astype(np.int32)
                ids = table[np.minimum(codes, len(table) - 1)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(1, np.int32), ends])), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(2), lists], names=["key", "ids"])

    names = ["segment", "key", "codes", "place", "word"]
    read = tokens.select(F.col(key).alias("key"), F.col(tokens_col).alias("tokens"))
    with stage_scope(spark) as used:
        segments = stage_packed(read.mapInArrow(local, f"segment long, key {kind.simpleString()}, codes array<int>, place int, word string"), "segments")
        docs = segments.where("codes IS NOT NULL").select("segment", F.lit(1).alias("side"), "key", "codes",
                                                          *[F.lit(None).cast("int").alias(c) for c in ("place", "id")])
        found = (segments.where("codes IS NULL").select("segment", "place", "word").join(lookup, "word")
                 .select("segment", F.lit(0).alias("side"), F.lit(None).cast(kind).alias("key"),
                         F.lit(None).cast("array<int>").alias("codes"), "place", "id"))
        parts = max(spark.sparkContext.defaultParallelism, segments.select("segment").distinct().count())
        met = found.unionByName(docs).repartition(parts, "segment").sortWithinPartitions("segment", "side")
        out = stage_packed(met.mapInArrow(known, f"key {kind.simpleString()}, ids array<int>"), "coded")
    remove_stages(spark, used[:-1])
    return out.withColumnRenamed("key", key)
