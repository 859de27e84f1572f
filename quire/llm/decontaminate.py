"""Benchmark decontamination with a broadcast hash set of n-gram windows.

Benchmark items and texts are normalised alike (ASCII lower case; words are
runs of digits, letters a-z and all characters from U+0080 on). The windows of
an item are its runs of ``n`` words; an item of fewer words, but not none, is
one window. A task maps a text's words to the benchmark's word numbers, rolls a
64-bit hash over every window position, looks the hashes up in the sorted set
and verifies each hit word by word.

Scale. Texts never move: the scan is one pass with no shuffle. The set is built
from at most ``BLOCK_BYTES`` of benchmark text; a larger benchmark is dealt
into blocks by item, and the scan is repeated block by block over a staged
copy, so a worker never holds more than one block.

Edge cases: a null or wordless text has no words and no hits; a null or
wordless item has no windows; a null item id is reported as the empty string;
repeated items count once; an empty benchmark finds nothing; other columns are
kept, and ``n_words``, ``spans``, ``n_hit`` and ``items`` replace columns of
those names.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, stage
from .common import packed_row, quoted, unpacked_row

WINDOW_WORDS = 10
BLOCK_BYTES = 16 << 20  # benchmark text per broadcast set (measured: 21 bytes of index a word, 81 while it is built)

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TO_SPACE = bytes(c if c in _KEEP else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().translate(_TO_SPACE).split()


class WindowSet:
    """The windows of a block of items: all words as one array of word numbers,
    and for each window length the windows' sorted hashes with the place and
    the item of each (arrays only, nothing in Python for each window)."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.ids: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        flat = array("i")
        starts: dict[int, list[np.ndarray]] = {}
        holders: dict[int, list[np.ndarray]] = {}
        for at, (_, text) in enumerate(items):
            first = len(flat)
            flat.extend(self.ids.setdefault(w, len(self.ids)) for w in words(text))
            size = min(n, len(flat) - first)
            if size:
                places = np.arange(first, len(flat) - size + 1, dtype=np.int32)
                starts.setdefault(size, []).append(places)
                holders.setdefault(size, []).append(np.full(len(places), at, dtype=np.int32))
        self.flat = np.array(flat, dtype=np.int32)
        self.tables = []
        for size in sorted(starts):
            place, item = np.concatenate(starts.pop(size)), np.concatenate(holders.pop(size))
            h = self.rolled([self.flat[place + k] for k in range(size)])
            order = np.lexsort((item, h))
            h, place, item = h[order], place[order], item[order]
            # a window that an item repeats is held once
            again = (h[1:] == h[:-1]) & (item[1:] == item[:-1])
            for k in range(size):
                again &= self.flat[place[1:] + k] == self.flat[place[:-1] + k]
            keep = np.concatenate([[True], ~again])
            self.tables.append((size, h[keep], place[keep], item[keep]))

    @staticmethod
    def rolled(columns) -> np.ndarray:
        """Polynomial hash (mod 2^64) of windows given as columns of word numbers."""
        h = None
        for c in columns:
            c = c.astype(np.uint64) + np.uint64(1)
            h = c if h is None else h * np.uint64(_BASE) + c
        return h

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, str]]]:
        """Number of words and the verified hits ``(first word, past the last, item)``."""
        found = words(text)
        hits: list[tuple[int, int, str]] = []
        if not found or not self.tables:
            return len(found), hits
        seq = np.fromiter(map(self.ids.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        unknown = np.concatenate([[0], np.cumsum(seq < 0)])
        for size, hashes, places, items in self.tables:
            if len(seq) < size:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(at):
                continue
            h = self.rolled([seq[at + k] for k in range(size)])
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            # every window of the hash: of several items, or by collision
            n = hi - lo
            at = np.repeat(at, n)
            row = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(len(at))
            same = np.ones(len(at), dtype=bool)
            for k in range(size):
                same &= seq[at + k] == self.flat[places[row] + k]
            hits.extend((p, p + size, self.names[i]) for p, i in
                        dict.fromkeys(zip(at[same].tolist(), items[row[same]].tolist())))
        return len(found), hits


def runs(hits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Merge an item's overlapping windows into spans."""
    out: list[tuple[int, int, str]] = []
    for item, a, b in sorted((item, a, b) for a, b, item in hits):
        if out and out[-1][2] == item and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), item)
        else:
            out.append((a, b, item))
    return out


_KNOWN: dict[str, WindowSet] = {}


def known_windows(name: str, sent: Broadcast, n: int) -> WindowSet:
    """The index of a block, built once in a Python worker; one block at a time."""
    if name not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[name] = WindowSet(sent.value, n)
    return _KNOWN[name]


def _scan_column(rows: DataFrame, items: list[tuple[str, str | None]], n: int):
    """Words and spans of column ``text``."""
    spark = rows.sparkSession
    ship_package(spark)
    sent, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = known_windows(name, sent, n)
        for texts in batches:
            rows = [index.scan(t) for t in texts]
            yield pd.DataFrame({
                "n_words": [k for k, _ in rows],
                "spans": [[{"first": a, "past": b, "item": i} for a, b, i in runs(h)] for _, h in rows]})

    kind = "struct<n_words:long,spans:array<struct<first:long,past:long,item:string>>>"
    return F.pandas_udf(run, kind).asNondeterministic()(F.col("text"))


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of about ``limit`` bytes, each small enough to send."""
    items = benchmark.select(F.coalesce(F.col(quoted(item)).cast("string"), F.lit("")).alias("i"),
                             F.col(quoted(text)).alias("t")).distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // limit))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == F.lit(k)) if n > 1 else items
        yield [(r["i"], r["t"]) for r in part.sort("i", "t").collect()]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text", n: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (array of first word, word past the
    last, item), ``n_hit`` (distinct words inside spans) and ``items``."""
    out = packed_row(docs, text=text)
    found = []
    for k, items in enumerate(_blocks(benchmark, item, item_text, block_bytes)):
        if k:  # one block's set in memory at a time
            out = stage(out, "decontaminate")
        found.append(f"scan{k}")
        out = out.withColumn(found[-1], _scan_column(out, items, n))
    spans = F.sort_array(F.concat(*[F.col(f"{c}.spans") for c in found]))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["to"], s["past"]).alias("to"),
                                (acc["n"] + F.greatest(F.lit(0), s["past"] - F.greatest(s["first"], acc["to"])))
                                .alias("n")))
    hits = out.select("row", F.col(f"{found[0]}.n_words").alias("n_words"), spans.alias("spans"))
    return unpacked_row(hits, docs.columns, n_words=F.col("n_words"), spans=F.col("spans"), n_hit=covered["n"],
                        items=F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"]))))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    import re

    raw = text.encode("utf-8")
    at = [m.span() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", raw.lower())]
    out, done, past = [], 0, 0
    for a, b in sorted(spans):
        a = max(a, past)
        if a < b:
            out.append(raw[done:at[a][0]])
            done, past = at[b - 1][1], b
    return b"".join([*out, raw[done:]]).decode("utf-8")


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", text: str = "text",
          **options) -> DataFrame:
    """``docs`` without contamination, in their own columns. ``documents`` drops
    every document with a hit; ``spans`` cuts the hit spans out and scans the
    result again until nothing is found (words that move together can complete
    a window)."""
    names = docs.columns
    if mode == "documents":
        # the scan's own columns get out of the way of equal names in docs
        kept = scan(packed_row(docs, text=text), benchmark, text="text", **options).where(F.col("n_hit") == 0)
        return unpacked_row(kept, names)
    if mode != "spans":
        raise ValueError(f"unknown mode {mode!r}")
    blocks = list(_blocks(benchmark, options.get("item", "item_id"), options.get("item_text", "text"),
                          options.get("block_bytes", BLOCK_BYTES)))
    rows = packed_row(docs, text=text)
    while True:
        for items in blocks:
            rows = rows.withColumn("text", _cut_column(rows, items, options.get("n", WINDOW_WORDS)))
            if len(blocks) > 1:
                rows = stage(rows, "decontaminate")
        # what one block's cuts move together can complete another's window
        if len(blocks) == 1 or scan(rows.select("text"), benchmark, text="text", **options).where("n_hit > 0").isEmpty():
            return rows.select(*[(F.col("text") if c == text else F.col(f"row.{quoted(c)}")).alias(c) for c in names])


def _cut_column(rows: DataFrame, items: list[tuple[str, str | None]], n: int):
    """Column ``text`` without the items' windows."""
    spark = rows.sparkSession
    ship_package(spark)
    sent, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = known_windows(name, sent, n)

        def one(t: str | None) -> str | None:
            while t and (hits := index.scan(t)[1]):
                t = cut_spans(t, [(a, b) for a, b, _ in hits])
            return t

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(F.col("text"))
