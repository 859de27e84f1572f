"""Documents with the lookup rows of their own words, as tasks for numpy.

A document needs the rows (vectors, numbers) of its distinct words, which a join of
all its words would repeat at each of them. Here documents are dealt over blocks by
a hash of their key; the distinct words of a block are joined with the lookup table
(by the planner's choice), and documents and rows of a block meet in one shuffle. A
task holds the rows of one block's words - about ``BLOCK_WORDS`` running words at
most, however many documents or words there are - and streams its documents by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship_package

BLOCK_WORDS = 8_000_000   # running words of a block, about


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of an Arrow column of equally long number lists."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def flat_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a column of word lists (null: none), and each one's row."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.repeat(np.arange(len(column)), lengths)


def deal(tokens: DataFrame, lookup: DataFrame, key: str, tokens_col: str) -> DataFrame:
    """``(block, side, key, tokens, word, value)`` sorted by block, side and key:
    side 0 has ``lookup(word, value)`` for the block's words, side 1 its documents."""
    docs = tokens.select(F.col(key).alias("key"), F.col(tokens_col).alias("tokens"))
    running = docs.agg(F.sum(F.greatest(F.size("tokens"), F.lit(0)).cast("long"))).first()[0] or 0
    blocks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-running // BLOCK_WORDS))
    docs = docs.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
    asked = docs.select("block", F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    kinds = {**dict(docs.dtypes), **dict(lookup.dtypes)}
    found = asked.join(lookup.select("word", "value"), "word").select(
        "block", F.lit(0).alias("side"), *[F.lit(None).cast(kinds[c]).alias(c) for c in ("key", "tokens")], "word", "value")
    read = docs.select("block", F.lit(1).alias("side"), "key", "tokens",
                       *[F.lit(None).cast(kinds[c]).alias(c) for c in ("word", "value")])
    return found.unionByName(read).repartition(blocks, "block").sortWithinPartitions("block", "side", "key")


def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, pa.RecordBatch]]:
    """``(block, words, values, documents)`` of the rows of ``deal``, in order."""
    at, held, words, values = None, [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        place = np.stack([batch.column(i).to_numpy() for i in range(2)])
        cuts = (np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            part, (block, side) = batch.slice(a, b - a), place[:, a].tolist()
            if block != at:
                at, held, words, values = block, [], None, None
            if side == 0:
                held.append((part.column("word"), part.column("value")))
                continue
            if words is None and held:
                words = pa.concat_arrays([w for w, _ in held])
                column = pa.concat_arrays([v for _, v in held])
                values = matrix(column) if pa.types.is_list(column.type) else column.to_numpy(zero_copy_only=False)
                held = []
            elif words is None:
                words, values = pa.array([], part.column("word").type), np.zeros((0, 1))
            yield block, words, values, part


def key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(keys, run, row, n, values)``: of each key, the lookup rows of its known words
    and how often they occur in its documents, in order of ``run``, the key's number
    in ``keys``. A key comes once, also if several documents have it."""
    kept: tuple | None = None  # of the last key, which may go on
    for block, words, values, part in documents(batches):
        keys = part.column("key").to_pylist()
        new = np.array([True, *[a != b for a, b in zip(keys[1:], keys)]])
        if kept is not None and (kept[0], kept[1]) != (block, keys[0]):
            yield [kept[1]], np.zeros(len(kept[2]), int), kept[2], kept[3], kept[4]
            kept = None
        run = np.cumsum(new) - 1
        flat, doc = flat_words(part.column("tokens"))
        row = pc.fill_null(pc.index_in(flat, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = row >= 0
        code, n = np.unique(run[doc[known]] * max(1, len(words)) + row[known], return_counts=True)
        run, row = code // max(1, len(words)), code % max(1, len(words))
        names = [k for k, first in zip(keys, new.tolist()) if first]
        if kept is not None:  # same block, same rows
            mine = run == 0
            first, place = np.unique(np.concatenate([kept[2], row[mine]]), return_inverse=True)
            summed = np.bincount(place, np.concatenate([kept[3], n[mine]]), len(first)).astype(np.int64)
            run, row, n = (np.concatenate(x) for x in ((np.zeros(len(first), int), run[~mine]), (first, row[~mine]), (summed, n[~mine])))
        last = run == len(names) - 1
        kept = (block, names[-1], row[last], n[last], values)
        if len(names) > 1:
            yield names[:-1], run[~last], row[~last], n[~last], values
    if kept is not None:
        yield [kept[1]], np.zeros(len(kept[2]), int), kept[2], kept[3], kept[4]


def run_sums(run: np.ndarray, rows: np.ndarray, runs: int) -> np.ndarray:
    """The sum of ``rows`` of each run (ascending numbers; runs may be absent)."""
    out = np.zeros((runs, rows.shape[1]), rows.dtype)
    if len(run):
        starts = np.flatnonzero(np.diff(run, prepend=-1))
        out[run[starts]] = np.add.reduceat(rows, starts, axis=0)
    return out


def by_key(tokens: DataFrame, lookup: DataFrame, key: str, tokens_col: str, summed: Callable, schema: str,
           names: list[str]) -> DataFrame:
    """``summed(keys, run, row, n, values)`` gives the columns after the key, for
    stretches of some keys' word counts; one row a key, in ``schema``."""
    ship_package(tokens.sparkSession)
    most = 1 << 17  # counts that a step widens to vectors at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, at, row, n, values in key_counts(batches):
            ends = np.searchsorted(at, np.arange(len(keys)), side="right")
            a = 0
            while a < len(keys):
                start = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, start + most, side="right")))
                rows = slice(start, ends[b - 1])
                columns = summed(b - a, at[rows] - a, row[rows], n[rows], values)
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:b], kind), *columns], names=names)
                a = b

    kind = to_arrow_type(tokens.schema[key].dataType)
    return deal(tokens, lookup, key, tokens_col).mapInArrow(run, schema)
