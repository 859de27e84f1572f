"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q, at least
``exponent`` * q and ``min_length`` words long, that no neighbouring word extends
keeping that period.

1. *Grammar.* The numbered words of a group of texts, each closed by a symbol of
   its own, are recompressed: block compression replaces every maximal block
   a^k by one symbol, pair compression splits the alphabet in two by a bit of a
   mixed symbol number and replaces every pair (left, right) by one symbol. Both
   alternate until each text is a single symbol. Each level keeps its symbols,
   the parent of each place and the first place of each parent: a run-length
   grammar of O(log n) levels and O(n) places in all.
2. *Candidates.* A run of period q matches itself q words on over (exponent - 1)
   * q words, so it covers ``exponent`` consecutive multiples of q that hold the
   same word. For every q only such places of its grid are asked about: the grids
   of all q together have n * H(n) places. In a streak of them the next one that
   the last answer did not cover is asked, 1, 2, 4, ... at a time.
3. *Extensions.* How far the words from i and from i + q agree, in both
   directions, is read off the grammar: climb while the two places can be
   aligned with symbols of the next level and those are equal, then walk down
   from the symbols that differ. Each level costs a constant number of steps,
   blocks of any length included. The same levels, read backwards, give the
   extension to the left.
4. A stretch found with several q keeps the smallest: by Fine and Wilf the others
   are its multiples.

Scale. No shuffle: a text's runs need that text only, and every task keeps
about ``GROUP_WORDS`` words (or one text) at a time.

Edge cases: a null, empty or blank text has no words and no runs; a very long
text is worked on whole; repeated rows and null keys give a row each; no rows
give no rows; columns besides key and text are ignored, whatever their names.
Words are runs of characters other than ASCII white space.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, quoted

EXPONENT = 4            # a run repeats its period so often at least
MIN_LENGTH = 6          # and has so many words
GROUP_WORDS = 1 << 18   # words recompressed together
QUERIES_AT_ONCE = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that distinct symbols stay distinct
OUT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Level:
    """Symbols of one level; ``up`` is each place's parent in the next level,
    ``first`` the first place of each parent (and the number of places)."""

    def __init__(self, sym: np.ndarray, starts: np.ndarray, blocks: bool):
        mark = np.zeros(len(sym), dtype=np.int32)
        mark[starts] = 1
        self.sym, self.blocks = sym, blocks
        self.up = np.cumsum(mark, dtype=np.int32) - np.int32(1)
        self.first = np.append(starts, len(sym)).astype(np.int32)

    def backwards(self) -> Level:
        back = object.__new__(Level)
        back.sym, back.blocks = self.sym[::-1], self.blocks
        back.up = (self.up[-1] - self.up)[::-1]
        back.first = (len(self.sym) - self.first)[::-1]
        return back


def block_starts(sym: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))


def pair_places(sym: np.ndarray, step: int) -> np.ndarray:
    """First places of the pairs (left, right) of this step; of both ways round
    the one with more pairs. Symbols below 0 close a text and pair with none."""
    bit = ((sym.astype(np.uint64) * MIX) >> np.uint64(63 - step % 64)).astype(np.uint8) & 1
    side = np.where(sym < 0, 2, bit)
    one = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1))
    two = np.flatnonzero((side[:-1] == 1) & (side[1:] == 0))
    return one if len(one) >= len(two) else two


def recompress(text: np.ndarray) -> list[Level]:
    """The levels of a text of symbols >= 0 between distinct closing symbols < 0
    (one at either end). The last level has no two neighbouring symbols >= 0."""
    sym, levels, free, step = text.astype(np.int32), [], int(text.max(initial=0)) + 1, 0
    while ((sym[1:] >= 0) & (sym[:-1] >= 0)).any():
        starts = block_starts(sym)
        if len(starts) < len(sym):
            sizes = np.diff(starts, append=len(sym))
            named, at = np.flatnonzero(sizes > 1), sym[starts]
            levels.append(Level(sym, starts, True))
            names, number = np.unique(at[named].astype(np.int64) * (len(sym) + 1) + sizes[named], return_inverse=True)
            at[named] = free + number
            sym, free = at, free + len(names)
        pairs = pair_places(sym, step)
        step += 1
        if len(pairs):
            keep = np.ones(len(sym), dtype=bool)
            keep[pairs + 1] = False
            names, number = np.unique(sym[pairs].astype(np.int64) * free + sym[pairs + 1], return_inverse=True)
            levels.append(Level(sym, np.flatnonzero(keep), False))
            merged = sym.copy()
            merged[pairs] = free + number
            sym, free = merged[keep], free + len(names)
    levels.append(Level(sym, np.arange(len(sym)), False))
    return levels


def extensions(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each pair of distinct places, how many symbols from there on agree."""
    px, py = x.astype(np.int32), y.astype(np.int32)
    left_at = np.zeros(len(px), dtype=np.int32)  # level at which the symbols differ
    going = np.flatnonzero(levels[0].sym[px] == levels[0].sym[py])
    for h in range(len(levels) - 1):
        if not len(going):
            break
        level, above = levels[h], levels[h + 1].sym
        a, b = px[going], py[going]
        ua, ub = level.up[a], level.up[b]
        ra, rb = level.first[ua + 1] - a, level.first[ub + 1] - b  # left of their groups
        whole = (level.first[ua] == a) & (level.first[ub] == b)
        # inside a group: past the rest of it, where the symbols here are equal
        step = np.where(whole, 0, np.minimum(ra, rb))
        a, b = a + step, b + step
        px[going], py[going] = a, b
        left_at[going] = h
        on = whole | (ra == rb)
        going, a, b = going[on], level.up[a[on]], level.up[b[on]]
        px[going], py[going], left_at[going] = a, b, h + 1
        going = going[above[a] == above[b]]
    for h in range(len(levels) - 2, -1, -1):
        down = np.flatnonzero(left_at > h)
        if not len(down):
            continue
        level = levels[h]
        ua, ub = px[down], py[down]
        a, b = level.first[ua], level.first[ub]
        step = (level.sym[a] == level.sym[b]).astype(np.int32)
        if level.blocks:
            step *= np.minimum(level.first[ua + 1] - a, level.first[ub + 1] - b)
        px[down], py[down], left_at[down] = a + step, b + step, h
    return px - x


def streaks(text: np.ndarray, sizes: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, first grid place, places) of every streak of grid places that,
    with the ``exponent`` - 1 after them, hold one word. ``text`` has the longest
    texts first, ``sizes`` are their words; each closing symbol follows its text."""
    ends = np.cumsum(sizes + 1) + 1
    out = []
    for q in range(1, int(sizes.max(initial=0)) // exponent + 1):
        reach = ends[np.searchsorted(-sizes, -exponent * q, side="right") - 1]  # texts long enough
        grid = text[:reach:q]
        same = grid[1:] == grid[:-1]
        hit = same[: len(same) - exponent + 2]
        for k in range(1, exponent - 1):
            hit = hit & same[k: len(same) - exponent + 2 + k]
        at = np.flatnonzero(hit)
        if len(at):
            new = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
            out.append((np.full(len(new), q), at[new] * q, np.diff(new, append=len(at))))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out))


def find(text: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT,
         min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; texts as ``streaks``
    takes them, after one more closing symbol."""
    period, at, left = streaks(text, sizes, exponent)
    found, width = [], 1
    if len(period):
        levels = recompress(text)
        back = [level.backwards() for level in levels]
    while len(period):
        n = np.minimum(left, width)
        width *= 2
        ends = np.cumsum(n)
        reach = np.empty(len(period), dtype=np.int64)  # end of the last stretch asked about
        lo = 0
        while lo < len(period):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + QUERIES_AT_ONCE)))
            m = n[lo:hi]
            q = np.repeat(period[lo:hi], m)
            first = np.cumsum(m) - m
            i = np.repeat(at[lo:hi], m) + (np.arange(len(q)) - np.repeat(first, m)) * q
            last = len(text) - 1
            start = i - extensions(back, last - (i - 1), last - (i + q - 1))
            end = i + q + extensions(levels, i, i + q)
            reach[lo:hi] = end[first + m - 1]
            run = end - start >= np.maximum(min_length, exponent * q)
            found.append((start[run], end[run], q[run]))
            lo = hi
        covered = np.maximum(n, -(-(reach - period - at) // period))  # grid places that need no more asking
        at, left = at + covered * period, left - covered
        rest = left > 0
        period, at, left = period[rest], at[rest], left[rest]
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, end, q = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    own = np.ones(len(q), dtype=bool)
    own[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[own], end[own], q[own]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def group_runs(texts: list[list[bytes]], exponent: int = EXPONENT,
               min_length: int = MIN_LENGTH) -> list[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """For each text of words its runs (start, length, period) and the words that
    remain when each run keeps its first period only."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], dtype=np.int64)
    offset = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1  # first word of each text
    text = np.empty(int(offset[-1]), dtype=np.int64)
    text[offset - 1] = -1 - np.arange(len(offset))
    for k, at, n in zip(order, offset.tolist(), sizes.tolist()):
        text[at:at + n] = np.fromiter(map(number.__getitem__, texts[k]), dtype=np.int64, count=n)
    start, end, q = find(text, sizes, exponent, min_length)
    out: list = [([], words) for words in texts]
    owner = np.searchsorted(offset, start, side="right") - 1
    bounds = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else []
    for a, b in zip(bounds[:-1], bounds[1:]):
        k, at = order[owner[a]], int(offset[owner[a]])
        s, e, p = start[a:b] - at, end[a:b] - at, q[a:b]
        cover = np.zeros(len(texts[k]) + 1, dtype=np.int64)
        np.add.at(cover, s + p, 1)
        np.add.at(cover, e, -1)
        kept = np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()
        out[k] = (list(zip(s.tolist(), (e - s).tolist(), p.tolist())), [texts[k][i] for i in kept])
    return out


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", exponent: int = EXPONENT,
              min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: the key, ``n_words``, ``runs`` (start,
    length, period, by start and period) and ``collapsed``, the words that
    remain when each run keeps its first period, joined by a space."""
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    rows = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("binary").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first, held = [], 0, 0
            for t in batch.column(1).to_pylist():
                words.append((t or b"").split())
                held += len(words[-1])
                if held >= GROUP_WORDS:
                    yield answer(batch.column(0).slice(first, len(words)), words)
                    first, words, held = first + len(words), [], 0
            if words:
                yield answer(batch.column(0).slice(first, len(words)), words)

    def answer(keys: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        found = group_runs(words, exponent, min_length)
        runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in f[0]] for f in found], pa.list_(RUN))
        kept = pa.array([b" ".join(f[1]) for f in found], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([keys, pa.array([len(w) for w in words], pa.int64()), runs, kept],
                                          names=["key", "n_words", "runs", "collapsed"])

    return (map_rows(rows, task, f"key {kind}, {OUT}")
            .select(F.col("key").alias(key), "n_words", "runs", "collapsed"))
