"""SimHash near-dedup by multi-index hashing.

``fingerprints`` gives every text its 64-bit SimHash; ``classes`` links
fingerprints that differ in at most 3 bits and returns each fingerprint's
connected class; ``near_duplicates`` puts both together per document.

Candidate search. A fingerprint is cut into two 32-bit segments. Two
fingerprints within 3 bits differ in at most one bit of one segment, so with a
table keyed by (segment, value) it is enough to look up, for each segment, the
value itself and its Hamming ball of radius 1. A pair that differs in exactly
one bit of a segment has that bit set on one side only, so only the set bits
are cleared when the ball is enumerated (about 17 keys a segment instead of
33): every pair is still met, from the side that has the bit. Complete
distances are then verified on all 64 bits.

Scale. Copies collapse first: the search runs over distinct fingerprints.
A bucket never leaves all its pairs behind: a task emits, for the rows it
compares, a spanning star of each component (at most one edge per row). A
bucket whose table side or probe side is large is dealt out as a grid of tiles
over many tasks; the sizes come from one small aggregate over the table rows.
Classes are closed by large-star / small-star rounds on DataFrames, each round
cut by a checkpoint in the shared folder.

Edge cases: null or blank text has fingerprint 0 and is linked like any other;
repeated rows are copies; a class id is the smallest non-null ``doc_id`` of the
class (null only if it has none); an empty table gives an empty result; columns
besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package, stage
from .common import map_rows, packed_row, quoted, unpacked_row

SHINGLE_WORDS = 3
MAX_BITS = 3          # the two radius-1 segment balls cover distances up to 3
TILE_ROWS = 4096      # table rows or probe rows of one bucket that one tile compares
BUFFER_ROWS = 200_000  # candidate rows a task holds while it looks for the end of a bucket
BLOCK_PAIRS = 500_000  # pairs compared at once
ROUND_ROWS = 250_000  # edges that one task of a component round writes
LOW32 = 0xFFFFFFFF


# -- fingerprints ---------------------------------------------------------

def simhash(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text: ASCII-lower-cased words between
    ASCII white space, ``shingle``-word windows with repeats, XXH64 (seed 42)."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)  # one shingle: its bits are the majority
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    n, counts = len(starts), np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65536], ends[at:at + 65536])],
                     dtype=">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint_column(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> Column:
    """The SimHash of ``text`` as a signed 64-bit Column."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            h = np.fromiter((simhash(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(h.view(np.int64))

    udf = F.pandas_udf(run, "long").asNondeterministic()
    return udf(F.col(quoted(text)))


# -- links between distinct fingerprints ----------------------------------

def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if k == 0 else fp.bitwiseAND(F.lit(LOW32))


def _bucket(value: Column, k: int) -> Column:
    """(segment, value) as one key: values are below 2^32, segment 1 gets bit 32."""
    return value if k == 0 else value.bitwiseOR(F.lit(1 << 32))


def _cleared(value: Column) -> Column:
    """``value`` with each of its set bits cleared in turn."""
    bits = F.array(*[F.lit(1 << i) for i in range(32)])
    return F.transform(F.filter(bits, lambda b: value.bitwiseAND(b) != 0), lambda b: value.bitwiseXOR(b))


def _table_rows(fps: DataFrame) -> DataFrame:
    pairs = F.array(*[_bucket(_segment(F.col("fp"), k), k) for k in (0, 1)])
    return fps.select("fp", F.explode(pairs).alias("key"))


def _probe_rows(fps: DataFrame) -> DataFrame:
    fp = F.col("fp")
    balls = F.concat(F.transform(_cleared(_segment(fp, 0)), lambda v: _bucket(v, 0)),
                     F.transform(_cleared(_segment(fp, 1)), lambda v: _bucket(v, 1)))
    return fps.select("fp", F.explode(balls).alias("key"))


def _large_buckets(table: DataFrame, tile_rows: int) -> DataFrame:
    """``(key, t_tiles, p_tiles)`` of buckets too large for one tile. Table
    sizes are counted; the probe side of a bucket is bounded by the table sizes
    of the buckets one bit away, so only neighbours of large buckets can be
    large themselves. Staged, so that the planner knows the (small) size."""
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.lit(tile_rows // 32))
    value, seg = F.col("key").bitwiseAND(F.lit(LOW32)), F.col("key").bitwiseAND(F.lit(1 << 32))
    near = F.transform(_cleared(value), lambda v: v.bitwiseOR(seg))
    probes = (sizes.select(F.explode(F.concat(F.array("key"), near)).alias("key"), "n")
              .groupBy("key").agg(F.sum("n").alias("p")))
    both = probes.join(sizes, "key", "left")
    tiles = lambda c: F.ceil(F.coalesce(c, F.lit(1)) / F.lit(tile_rows)).cast("int")
    return stage(both.select("key", tiles(F.col("n")).alias("t_tiles"), tiles(F.col("p")).alias("p_tiles"))
                 .where((F.col("t_tiles") > 1) | (F.col("p_tiles") > 1)), "simhash-tiles")


def _spread(name: str, n: str, salt: int) -> Column:
    return F.pmod(F.xxhash64("fp", F.lit(salt)), F.coalesce(F.col(n), F.lit(1))).cast("int").alias(name)


def _all(name: str, n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1)).alias(name)


def link_edges(fps: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges ``(a, b)`` whose transitive closure joins exactly the distinct
    fingerprints ``fps(fp)`` that are linked at ``MAX_BITS`` or fewer bits."""
    table = _table_rows(fps)
    large = _large_buckets(table, tile_rows)
    # a table row meets every probe tile of its bucket and the reverse
    rows = (table.join(large, "key", "left")
            .select("key", "fp", F.lit(0).alias("probe"), _spread("t", "t_tiles", 1), "p_tiles")
            .select("key", "fp", "probe", "t", _all("p", "p_tiles")))
    # in a tiled bucket the table rows are probes as well; elsewhere the task
    # compares the table rows with each other itself
    again = table.join(large, "key").where(F.col("t_tiles") > 1)
    probes = (_probe_rows(fps).join(large, "key", "left").select("key", "fp", "t_tiles", "p_tiles")
              .unionByName(again.select("key", "fp", "t_tiles", "p_tiles"))
              .select("key", "fp", F.lit(1).alias("probe"), _spread("p", "p_tiles", 2), "t_tiles")
              .select("key", "fp", "probe", _all("t", "t_tiles"), "p"))
    dealt = (rows.unionByName(probes).repartition("key", "t", "p")
             .sortWithinPartitions("key", "t", "p", "probe"))
    return map_rows(dealt.select("key", "t", "p", "probe", "fp"), _edges_task, "a long, b long")


def _edges_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)])
        held.append(cols)
        n += cols.shape[1]
        if n >= BUFFER_ROWS:
            cols = np.concatenate(held, axis=1)
            last = np.flatnonzero((cols[:3, 1:] != cols[:3, :-1]).any(axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield _edge_batch(cols[:, :cut])
            held, n = [cols[:, cut:]], cols.shape[1] - cut
    if n:
        yield _edge_batch(np.concatenate(held, axis=1))


def _edge_batch(cols: np.ndarray) -> pa.RecordBatch:
    a, b = bucket_edges(*cols)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def bucket_edges(key, t, p, probe, fp) -> tuple[np.ndarray, np.ndarray]:
    """Star edges over whole buckets (rows sorted by bucket, table rows first).
    Small buckets are expanded together, in blocks of ``BLOCK_PAIRS`` pairs."""
    n = len(fp)
    change = np.flatnonzero((key[1:] != key[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])) + 1
    first = np.concatenate([[0], change])
    size = np.diff(np.concatenate([first, [n]]))
    tables = np.add.reduceat(1 - probe, first)
    bits = fp.view(np.uint64)
    useful = (tables > 0) & (size > 1)
    first, size, tables = first[useful], size[useful], tables[useful]
    # each row of a bucket is compared with the bucket's table rows
    row = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    start, width = np.repeat(first, size), np.repeat(tables, size)
    done = np.concatenate([[0], np.cumsum(width)])
    out_a, out_b = [], []
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(done, done[at] + BLOCK_PAIRS, side="right")) - 1)
        w = width[at:to]
        i = np.repeat(row[at:to], w)
        j = np.repeat(start[at:to], w) + np.arange(len(i)) - np.repeat(done[at:to] - done[at], w)
        near = np.bitwise_count(bits[i] ^ bits[j]) <= MAX_BITS
        near &= bits[i] != bits[j]
        a, b = star(fp[i[near]], fp[j[near]])
        out_a.append(a)
        out_b.append(b)
        at = to
    if not out_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return star(np.concatenate(out_a), np.concatenate(out_b))


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) of the graph ``a - b``."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = label[label]
        if (label[i] == label[j]).all():
            break
    label = label[label]
    while (label[label] != label).any():
        label = label[label]
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


# -- classes ----------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: large-star and
    small-star rounds until nothing moves; the root is the smallest node."""
    def large(e: DataFrame) -> DataFrame:
        """Link every node to the least neighbour of each of its smaller neighbours
        (edges run from the larger node a to the smaller b, so b's least
        neighbour is among the edges that start at b)."""
        least = e.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        return (e.join(least, e["b"] == least["u"], "left")
                .select("a", F.coalesce("m", "b").alias("b")))

    def small(e: DataFrame) -> DataFrame:
        """Link u and its smaller neighbours to the least of them."""
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        others = e.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return others.union(least.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame) -> tuple:
        """Number of edges and two sums of their 64-bit hashes: equal if the edges are."""
        total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
        return tuple(e.agg(F.count(F.lit(1)), total("a", "b"), total("b", F.lit(1), "a")).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where(F.col("a") != F.col("b")).distinct())
    was = None
    while (seen := mark(now)) != was and seen[0]:
        tasks = -(-seen[0] // ROUND_ROWS)  # files and tasks by the measured number of edges
        was, now = seen, materialize(small(large(now)).coalesce(tasks))
    # at the fixed point every node points at its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b"))).distinct()


def classes(fps: DataFrame) -> DataFrame:
    """``(fp, root)`` for distinct fingerprints ``fps(fp)``: root is the smallest
    (signed) fingerprint of the class, the fingerprint itself if it is alone."""
    found = components(link_edges(fps))
    return (fps.join(found, fps["fp"] == found["node"], "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``(key, fp, root, component)`` with the
    signed fingerprint, the class's smallest fingerprint and its smallest key."""
    marked = stage(docs.select(F.col(quoted(key)).alias("k"), fingerprint_column(docs, text, shingle).alias("fp")),
                   "simhash-fp")
    groups = stage(marked.groupBy("fp").agg(F.min("k").alias("k")), "simhash-distinct")
    member = classes(groups.select("fp"))
    by_root = groups.join(member, "fp").select("fp", "root", "k")
    named = by_root.join(by_root.groupBy(F.col("root").alias("r")).agg(F.min("k").alias("component")),
                         F.col("root") == F.col("r")).select("fp", "root", "component")
    return marked.join(named, "fp").select(F.col("k").alias(key), "fp", "root", "component")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text",
             shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the smallest key
    (nulls last), and one row of it if that key is repeated. All columns stay.

    The texts are written once with their fingerprint and a row number; only
    (row, key, fingerprint) goes through the search, and the winning rows are
    fetched by a semi join on the unique row number."""
    rows = packed_row(docs, key=key, text=text)
    marked = stage(rows.select("row", "key", fingerprint_column(rows, "text", shingle).alias("fp"),
                               F.monotonically_increasing_id().alias("number")), "simhash-docs")
    rank = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("k"), "number")
    groups = stage(marked.groupBy("fp").agg(F.min(rank).alias("best")), "simhash-distinct")
    member = classes(groups.select("fp"))
    winners = (groups.join(member, "fp").groupBy("root").agg(F.min("best").alias("best"))
               .select("best.number"))
    return unpacked_row(marked.join(winners, "number", "left_semi"), docs.columns)
