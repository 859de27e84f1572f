"""Word vectors by training (VEC-1, UDF-3, UDF-5) and document vectors by
inference, as joins and sums.

*Words.* From the counts of (word, context) within a window, the positive
pointwise mutual information max(0, ln(n * N / (n(word) * n(context)))) gives a
sparse symmetric matrix over the vocabulary. Its leading subspace is found by
randomised block power iterations: a thin block of pseudo-random signs (from
the seed and the word) is multiplied by the matrix ``maxIter`` times and made
orthonormal in between with the eigenvectors of its small Gram matrix. At the end the matrix is projected on the
block, and a word's vector is its row of the eigenvectors with the largest
eigenvalues in size, each scaled by the root of that size. More epochs mean a
smaller distance to the exact subspace; ``vectorSize``, ``windowSize``,
``minCount``, ``maxIter`` and ``seed`` all act. (``stepSize`` belongs to
Word2Vec; nothing here descends a gradient.)

*Documents.* With word vectors v, a document's vector x is the ridge solution of
a(word) = v(word) . x over the whole vocabulary, where a is ln(1 + count) of the
document's words and 0 for all others. The normal equations share one Gram matrix
of the word vectors, so a document needs only the sum of a * v over its distinct
words (in blocks, see ``dealt``), and a document that was not there in training gets the vector it would
have had.

Scale. Words are numbers here (``coded``), dealt over strips of the matrix by hash, and
the matrix is cut into tiles of two strips, of which the upper half is stored: sorted
cells as differences of their numbers, packed, a few bytes each. Tasks count each two
places once and send packed counts to the buckets of a tile. The values are made of the
counts when a tile is read. In each iteration a tile meets the rows of the thin block of
its two strips only, and packed sums for these strips are shuffled; shuffles and folders
of finished steps are deleted. Only Gram matrices of ``vectorSize`` + ``OVERSAMPLE``
columns and counts reach the driver, summed on the executors.

Edge cases: a word without a positive cell has the zero vector; fewer words than
``vectorSize`` leave the last columns 0; a document without a word of the model
has the zero vector; null token lists count as empty; no documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_stages, ship_package, stage, stage_packed, stage_scope
from . import coded, dealt
from .coded import CHUNK_WORDS, PLACES, STRIP_WORDS
from .training import model_options, signatures

OVERSAMPLE = 10       # columns beyond vectorSize that speed the iterations up
RIDGE = 1.0
STEP_PLACES = 1 << 18  # places whose pairs a task codes at once
HELD_PAIRS = 6_000_000  # counts that a task holds
BUCKET_PAIRS = 8_000_000  # running pairs of a bucket, whose counts one task sums up
ROW_CELLS = 1 << 16   # cells of a stored row
FEW_WORDS = 1000      # words that are not worth more than one strip
CODED = 1 << 31       # words that a code of two word numbers has room for
SMALLEST = 1e-12      # eigenvalues below this share of the largest count as 0


# -- packed cells: ascending codes of two numbers, with counts ---------------------

def packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Differences of the codes and the counts, byte by byte of their 8."""
    planes = np.stack([np.diff(codes, prepend=0), counts]).astype("<i8").view(np.uint8).reshape(2, -1, 8)
    return pa.compress(planes.transpose(0, 2, 1).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 16 * size, codec="zstd", asbytes=True), np.uint8).reshape(2, 8, size)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[..., 0]
    return np.cumsum(steps), counts


def _summed(held: list) -> tuple[np.ndarray, np.ndarray]:
    """The codes in ``held``, each once and ascending, with the sums of their counts."""
    codes, counts = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    return codes[order][cuts], np.add.reduceat(counts[order], cuts) if len(cuts) else counts


def _counted(words: pa.Array | None, held: list) -> Iterator[pa.RecordBatch]:
    """Rows of the counts in ``held``, by code."""
    if not held:
        return
    codes, counts = _summed(held)
    for a in range(0, len(codes), 1 << 16):
        part = codes[a:a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([words.take(pa.array(part // len(words))), words.take(pa.array(part % len(words))),
                                          pa.array(counts[a:a + (1 << 16)])], names=["word", "context", "n"])


def _pairs(row: np.ndarray, doc: np.ndarray, window: int, words: int) -> np.ndarray:
    """Codes of the pairs of known words whose first place is one of the first
    ``STEP_PLACES``."""
    out = [np.zeros(0, np.int64)]
    for k in range(1, min(window, len(row) - 1) + 1):
        left, right = row[:-k][:STEP_PLACES], row[k:][:STEP_PLACES]
        kept = (left >= 0) & (right >= 0) & (doc[:-k][:STEP_PLACES] == doc[k:][:STEP_PLACES])
        left, right = left[kept], right[kept]
        out.append(np.minimum(left, right) * words + np.maximum(left, right))
    return np.concatenate(out)


# -- counts in tiles ---------------------------------------------------------------

def tile_of(row, col):
    """The number of the tile of two strips, ``row`` <= ``col`` (arrays or columns)."""
    return col * (col + 1) / 2 + row


@dataclass
class Counts:
    """Symmetric counts of word pairs. ``tiles(tile, seq, size, data)`` has the cells of
    the upper half, those of two equal words doubled; ``strips`` the words."""
    tiles: DataFrame
    strips: DataFrame
    grid: int

    def rows(self) -> DataFrame:
        """``(word, context, n)`` of one order of two words."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for tile in _tiles(batches):
                for _, at, n in tile.cells():
                    yield from _counted(tile.words, [(at[0] * len(tile.words) + at[1], n)])

        return tile_pass(self, self.strips.select("strip", "chunk", "words"), run, "word string, context string, n long")


def _grid(words: int, tasks: int) -> int:
    """Strips of the matrix: of about ``STRIP_WORDS`` at most; smaller ones, so that
    there are 2 tiles for each task, but not below ``FEW_WORDS``."""
    enough = int(np.ceil((np.sqrt(16 * tasks + 1) - 1) / 2))
    return max(1, -(-words // STRIP_WORDS), min(enough, -(-words // FEW_WORDS)))


def cooccurrences(tokens: DataFrame, vocabulary: DataFrame, window: int, tokens_col: str = "tokens") -> Counts:
    """How often two words of ``vocabulary(word)`` stand within ``window`` places of
    each other, stored. Tasks count each two places once; only packed counts are
    shuffled, of one order of the two words."""
    spark = tokens.sparkSession
    ship_package(spark)
    grid = _grid(vocabulary.select("word").distinct().count(), spark.sparkContext.defaultParallelism)
    strips = stage(coded.strips(vocabulary, grid), "strips")
    with stage_scope(spark) as used:
        docs = coded.documents(tokens.select(F.lit(0).alias("key"), F.col(tokens_col).alias("tokens")),
                               coded.numbers(strips), "key", "tokens").select("ids")
    places = docs.agg(F.sum(F.size("ids").cast("long"))).first()[0] or 0
    tiles = grid * (grid + 1) // 2
    parts = max(1, -(-places * window // (BUCKET_PAIRS * tiles)))  # buckets of a tile

    def bucket(codes: np.ndarray) -> np.ndarray:
        first, second = codes // CODED, codes % CODED
        return tile_of(first // PLACES, second // PLACES).astype(np.int64) * parts + first % PLACES % parts

    def sent(codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        to = bucket(codes)
        order = np.argsort(to, kind="stable")
        to, codes, counts = to[order], codes[order], counts[order]
        starts = np.flatnonzero(np.diff(to, prepend=-1)).tolist()
        cuts = [(c, min(c + ROW_CELLS, b)) for a, b in zip(starts, [*starts[1:], len(to)]) for c in range(a, b, ROW_CELLS)]
        for i in range(0, len(cuts), 64):
            some = cuts[i:i + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array([to[a] for a, _ in some], pa.int32()), pa.array([b - a for a, b in some], pa.int32()),
                 pa.array([packed(codes[a:b], counts[a:b]) for a, b in some], pa.binary())], names=["bucket", "size", "data"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            flat, doc = dealt.flat_words(batch.column(0))
            row = flat.to_numpy().astype(np.int64)
            for a in range(0, len(row), STEP_PLACES):
                codes = _pairs(row[a:a + STEP_PLACES + window], doc[a:a + STEP_PLACES + window], window, CODED)
                held.append(np.unique(codes, return_counts=True))
                size += len(held[-1][0])
                if size > HELD_PAIRS:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD_PAIRS // 2:
                        yield from sent(*held[0])
                        held, size = [], 0
        if size:
            yield from sent(*_summed(held))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, seq = None, [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal held
            codes, counts = _summed(held)
            held = []
            counts = np.where(codes // CODED == codes % CODED, 2 * counts, counts)
            for k, a in enumerate(range(0, len(codes), ROW_CELLS)):
                some = slice(a, min(a + ROW_CELLS, len(codes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // parts], pa.int32()), pa.array([(at % parts << 32) + k], pa.int64()),
                     pa.array([some.stop - a], pa.int32()), pa.array([packed(codes[some], counts[some])], pa.binary())],
                    names=["tile", "seq", "size", "data"])

        for batch in batches:
            for to, size, data in zip(*(c.to_pylist() for c in batch.columns)):
                if to != at and held:
                    yield from rows()
                at = to
                held.append(unpacked(data, size))
        if held:
            yield from rows()

    met = docs.mapInArrow(count, "bucket int, size int, data binary").repartitionById(tiles * parts, F.col("bucket"))
    cells = stage_packed(met.sortWithinPartitions("bucket").mapInArrow(add, "tile int, seq long, size int, data binary"), "counts")
    remove_stages(spark, used)
    return Counts(cells, strips, grid)


# -- tiles with the rows of their strips ---------------------------------------------

class Tile:
    """A tile's packed cells and what its two strips have: words, totals, rows of a
    thin block (each only if it was sent)."""

    def __init__(self, number: int, sides: tuple[list, list], data: list):
        self.number, self.data = number, data
        self.same = not sides[1]
        both = (sides[0], sides[0] if self.same else sides[1])
        self.strips = [side[0]["strip"] for side in sides if side]
        words, totals, block = ([[r[c] for r in side if r[c] is not None] for side in both] for c in ("words", "totals", "x"))
        self.first = sum(map(len, words[0]))  # words of the first strip, before those of the second
        self.words = pa.concat_arrays(words[0] + words[1]) if words[0] else None
        self.totals, self.block = ([np.frombuffer(b"".join(x), kind) for x in found] for found, kind in ((totals, "<i8"), (block, "<f8")))

    def cells(self) -> Iterator[tuple]:
        """``(places in the two strips, numbers in words, counts)`` of stretches of cells."""
        for size, data in self.data:
            codes, n = unpacked(data, size)
            row, col = codes // CODED % PLACES, codes % PLACES
            yield (row, col), (row, self.first + col), n


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[Tile]:
    """The tiles of the rows of ``tile_pass``, in order."""
    at, sides, data = None, ([], []), []
    for batch in batches:
        words = batch.column("words")
        columns = [batch.column(c).to_pylist() for c in ("tile", "side", "strip", "size", "data", "totals", "x")]
        for i, (tile, side, strip, size, cells, totals, x) in enumerate(zip(*columns)):
            if tile != at:
                if data:
                    yield Tile(at, sides, data)
                at, sides, data = tile, ([], []), []
            if side == 2:
                data.append((size, cells))
            else:
                sides[side].append({"strip": strip, "words": words.slice(i, 1).flatten() if words[i].is_valid else None, "totals": totals, "x": x})
    if data:
        yield Tile(at, sides, data)


SENT = {"tile": "int", "side": "int", "strip": "int", "chunk": "long", "size": "int", "data": "binary", "words": "array<string>",
        "totals": "binary", "x": "binary"}


def tile_pass(counts: Counts, rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the rows of each tile: those of ``rows(strip, chunk, ...)`` of its two
    strips (side 0 and 1; side 0 alone if they are one), then its cells (side 2)."""
    grid, other = counts.grid, F.col("other")
    each = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    tile = tile_of(F.least("strip", other), F.greatest("strip", other)).cast("int")
    blank = [F.lit(None).cast(k).alias(c) for c, k in SENT.items() if c not in (*rows.columns, "tile", "side")]
    each = each.select(tile.alias("tile"), F.when(other < F.col("strip"), 1).otherwise(0).alias("side"),
                       *[F.col(c).cast(SENT[c]).alias(c) for c in rows.columns], *blank)
    cells = counts.tiles.select("tile", F.lit(2).alias("side"), F.col("seq").alias("chunk"), "size", "data",
                                *[F.lit(None).cast(SENT[c]).alias(c) for c in ("strip", "words", "totals", "x")])
    met = each.select(*SENT).unionByName(cells.select(*SENT)).repartitionById(grid * (grid + 1) // 2, F.col("tile"))
    return met.sortWithinPartitions("tile", "side", "chunk").mapInArrow(run, schema)


PART = "strip int, chunk int, tile int, data binary"


def _batch(rows: list, names: str) -> pa.RecordBatch:
    kinds = {"data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int32())) for n, c in zip(names.split(), zip(*rows))], names=names.split())


def _chunks(strip: int, tile: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a tile adds to the rows of a strip, by chunk."""
    for k, a in enumerate(range(0, len(rows), CHUNK_WORDS)):
        yield _batch([(strip, k, tile, rows[a:a + CHUNK_WORDS].tobytes())], "strip chunk tile data")


def _added(parts: DataFrame, grid: int, kind: str) -> DataFrame:
    """``(strip, chunk, data)``: sums of the equally long number rows ``data`` of a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for strip, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("strip", "chunk", "data"))):
                if at == (strip, chunk):
                    total += np.frombuffer(data, kind)
                    continue
                if at is not None:
                    yield _batch([(*at, total.tobytes())], "strip chunk data")
                at, total = (strip, chunk), np.frombuffer(data, kind).copy()
        if at is not None:
            yield _batch([(*at, total.tobytes())], "strip chunk data")

    met = parts.repartitionById(grid, F.col("strip")).sortWithinPartitions("strip", "chunk", "tile")
    return met.mapInArrow(run, "strip int, chunk int, data binary")


def _numbers_sum(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the matrices that ``_cells_of`` gave, on the executors."""
    out = np.zeros(width * width)
    for r in parts.groupBy("i").agg(F.sum("x").alias("x")).collect():  # width * width numbers
        out[r["i"]] = r["x"]
    return out.reshape(width, width)


def _cells_of(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["i", "x"])


# -- the matrix ------------------------------------------------------------------------

@dataclass
class Ppmi:
    """The matrix of positive pointwise mutual information, whose values are made of
    ``counts`` when they are read: ``strips(strip, chunk, words, totals)`` has the sums
    of the words' counts, stored, and ``everything`` is the sum of all."""
    counts: Counts
    strips: DataFrame
    everything: float


def ppmi_matrix(counts: Counts) -> Ppmi:
    """The matrix of symmetric counts."""
    spark, strips = counts.tiles.sparkSession, counts.strips

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            totals = [np.zeros(n, np.int64) for n in (tile.first, len(tile.words) - tile.first)]
            for (row, col), _, n in tile.cells():
                apart = row != col if tile.same else slice(None)
                for sums, at, some in zip(totals, (row, col[apart]), (n, n[apart])):
                    sums += np.bincount(at, some, len(sums)).astype(np.int64)
            for strip, sums in zip(tile.strips, [totals[0] + totals[1]] if tile.same else totals):
                yield from _chunks(strip, tile.number, sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(x, "<i8").sum()) for x in batch.column(0).to_pylist()], pa.int64())], names=["n"])

    parts = tile_pass(counts, strips.select("strip", "chunk", "words"), run, PART)
    with stage_scope(spark) as used:
        sums = stage_packed(_added(parts, counts.grid, "<i8"), "totals").withColumnRenamed("data", "totals")
    # a strip without cells is in no tile: nothing asks for its totals
    found = stage(strips.join(sums, ["strip", "chunk"]).select("strip", "chunk", "words", "totals"), "strip-totals")
    everything = found.select("totals").mapInArrow(total, "n long").agg(F.sum("n")).first()[0] or 0
    remove_stages(spark, used)
    return Ppmi(counts, found, float(everything))


def _values(tile: Tile, everything: float) -> Iterator[tuple]:
    """``(row, column, numbers in words, value)`` of the positive cells of a tile."""
    for (row, col), at, n in tile.cells():
        value = np.log(n * everything / (tile.totals[0][row].astype(float) * tile.totals[1][col]))
        kept = value > 0
        yield row[kept], col[kept], [x[kept] for x in at], value[kept]


def ppmi(counts: Counts) -> DataFrame:
    """``(word, context, value)``: the positive pointwise mutual information of
    symmetric counts; cells of 0 are left out."""
    matrix = ppmi_matrix(counts)
    everything = matrix.everything

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            for row, col, at, value in _values(tile, everything):
                one, other = (tile.words.take(pa.array(x)) for x in at)
                yield pa.RecordBatch.from_arrays([one, other, pa.array(value)], names=names)
                apart = pa.array(row != col if tile.same else np.ones(len(row), bool))
                yield pa.RecordBatch.from_arrays([x.filter(apart) for x in (other, one, pa.array(value))], names=names)

    names = ["word", "context", "value"]
    return tile_pass(counts, matrix.strips, run, "word string, context string, value double")


# -- thin blocks: (strip, chunk, data), the chunk's rows of numbers --------------------

def _added_products(sums: np.ndarray, row: np.ndarray, value: np.ndarray, block: np.ndarray, col: np.ndarray) -> None:
    """Add the products of cells, ascending by row, with the block's rows."""
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    if len(starts):
        sums[row[starts]] += np.add.reduceat(block[col] * value[:, None], starts, axis=0)


def _products(tile: Tile, everything: float, columns: int) -> tuple[list, list]:
    """The block's rows of a tile's strips, and what the tile adds to their product."""
    block = [x.reshape(-1, columns) for x in tile.block]
    sums = [np.zeros_like(x) for x in block]
    small = np.uint16 if len(block[1]) <= 1 << 16 else np.int64  # sorted faster
    for row, col, _, value in _values(tile, everything):
        _added_products(sums[0], row, value, block[1], col)
        if tile.same:
            apart = row != col
            row, col, value = row[apart], col[apart], value[apart]
        order = np.argsort(col.astype(small), kind="stable")
        _added_products(sums[1], col[order], value[order], block[0], row[order])
    return (block[:1], [sums[0] + sums[1]]) if tile.same else (block, sums)


def _with_totals(matrix: Ppmi, block: DataFrame) -> DataFrame:
    x = block.select("strip", "chunk", F.lit(None).cast("binary").alias("totals"), F.col("data").alias("x"))
    return matrix.strips.select("strip", "chunk", "totals", F.lit(None).cast("binary").alias("x")).unionByName(x)


def multiplied(matrix: Ppmi, block: DataFrame, columns: int) -> DataFrame:
    """The matrix times a block of so many columns: products of tiles, summed by strip."""
    everything = matrix.everything

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches):
            for strip, sums in zip(tile.strips, _products(tile, everything, columns)[1]):
                yield from _chunks(strip, tile.number, sums)

    return _added(tile_pass(matrix.counts, _with_totals(matrix, block), run, PART), matrix.counts.grid, "<f8")


def projected(matrix: Ppmi, block: DataFrame, columns: int) -> np.ndarray:
    """The block's transpose times the matrix times the block."""
    everything = matrix.everything

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns, columns))
        for tile in _tiles(batches):
            total += sum(x.T @ sums for x, sums in zip(*_products(tile, everything, columns)))
        yield _cells_of(total)

    with stage_scope(block.sparkSession) as used:  # stored, so that the blocks sent to the tiles go at once
        parts = stage_packed(tile_pass(matrix.counts, _with_totals(matrix, block), run, "i int, x double"), "projected")
    total = _numbers_sum(parts, columns)
    remove_stages(block.sparkSession, used)
    return total


def signs(strips: DataFrame, width: int, seed: int) -> DataFrame:
    """The block of the words' signs, and a last column of ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for strip, chunk, words in zip(*(c.to_pylist() for c in batch.columns)):
                found = signatures([f"{seed}/{w}" for w in words], width).astype(float)
                yield _batch([(strip, chunk, np.hstack([found, np.ones((len(words), 1))]).tobytes())], "strip chunk data")

    return strips.select("strip", "chunk", "words").mapInArrow(run, "strip int, chunk int, data binary")


def times(block: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``block`` with each row multiplied by a small matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for strip, chunk, data in zip(*(c.to_pylist() for c in batch.columns)):
                yield _batch([(strip, chunk, (np.frombuffer(data).reshape(-1, len(matrix)) @ matrix).tobytes())], "strip chunk data")

    return block.select("strip", "chunk", "data").mapInArrow(run, "strip int, chunk int, data binary")


def block_gram(block: DataFrame, columns: int) -> tuple[np.ndarray, int]:
    """The sum of the outer products of the block's rows, and the number of rows whose
    last column is above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((columns + 1, columns + 1))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                rows = np.frombuffer(data).reshape(-1, columns)
                total[:-1, :-1] += rows.T @ rows
                total[-1, -1] += (rows[:, -1] > 0).sum()
        yield _cells_of(total)

    total = _numbers_sum(block.select("data").mapInArrow(run, "i int, x double"), columns + 1)
    return total[:-1, :-1], int(total[-1, -1])


def whitening(g: np.ndarray) -> np.ndarray:
    """The matrix that makes columns of Gram matrix ``g`` orthonormal; directions
    without weight become 0."""
    size, axes = np.linalg.eigh((g + g.T) / 2)
    keep = size > SMALLEST * max(size.max(initial=0.0), np.finfo(float).tiny)
    return axes * np.where(keep, 1 / np.sqrt(np.where(keep, size, 1.0)), 0.0)


def train_subspace(tokens: DataFrame, options: dict | None = None, tokens_col: str = "tokens",
                   vocabulary: DataFrame | None = None) -> DataFrame:
    """VEC-1: ``(word, vector array<double>)`` of the words seen at least
    ``minCount`` times, or of the given ``vocabulary(word)``; nothing of ``tokens`` is
    read after the call."""
    opts = model_options(options)
    if vocabulary is None:
        vocabulary = (tokens.select(F.explode(tokens_col).alias("word")).groupBy("word")
                      .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= opts["minCount"]))
    vocabulary = stage_packed(vocabulary.select("word").distinct(), "vocabulary")
    spark = tokens.sparkSession
    with stage_scope(spark) as used:
        matrix = ppmi_matrix(cooccurrences(tokens, vocabulary, opts["windowSize"], tokens_col))
        found = leading_subspace(matrix, opts["vectorSize"], opts["maxIter"], opts["seed"])
    remove_stages(spark, used[:-1])  # all but the vectors
    zero = F.array_repeat(F.lit(0.0), opts["vectorSize"])
    return vocabulary.join(found, "word", "left").select("word", F.coalesce("vector", zero).alias("vector"))


def leading_subspace(matrix: Ppmi, size: int, epochs: int, seed: int = 42) -> DataFrame:
    """``(word, vector)``, stored, for the symmetric matrix after ``epochs`` block power
    iterations."""
    spark, width = matrix.strips.sparkSession, size + OVERSAMPLE
    block, columns = signs(matrix.strips, width, seed), width + 1
    before: list[str] = []
    for epoch in range(max(1, epochs)):
        with stage_scope(spark) as used:
            product = stage_packed(multiplied(matrix, block, columns), "subspace")
        g, words = block_gram(product, columns)
        turn = whitening(g[:width, :width])
        block, columns = times(product, np.vstack([turn, np.zeros((columns - width, width))])), width
        remove_stages(spark, before)
        before = used
        if epoch == 0 and words <= width:  # those with a positive cell
            break  # the block spans everything at once
    inner = projected(matrix, block, width)
    values, axes = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-np.abs(values), kind="stable")[:size]
    axes = axes[:, best] * np.sign(axes[np.abs(axes[:, best]).argmax(axis=0), best])
    vectors = times(block, axes * np.sqrt(np.abs(values[best])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column(1).to_pylist()):
                words = batch.column(0).slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays([words, _lists(np.frombuffer(data).reshape(len(words), -1))], names=["word", "vector"])

    both = matrix.strips.select("strip", "chunk", "words").join(vectors, ["strip", "chunk"]).select("words", "data")
    found = stage_packed(both.mapInArrow(run, "word string, vector array<double>"), "subspace-words")
    remove_stages(spark, before)
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1]).cast(pa.list_(pa.float64()))


def gram(rows: DataFrame, width: int, left: str = "b", right: str = "b") -> np.ndarray:
    """The sum over all rows of the outer products of two array columns."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0)).T @ _matrix(batch.column(1))
        yield _cells_of(total)

    return _numbers_sum(rows.select(F.col(left).alias("l"), F.col(right).alias("r")).mapInArrow(run, "i int, x double"), width)


# -- documents ------------------------------------------------------------------

class DocumentModel:
    """Word vectors with the inverse of their regularised Gram matrix."""

    def __init__(self, word_vectors: DataFrame, size: int, ridge: float = RIDGE):
        self.size = size
        self.words = stage(word_vectors.select("word", F.col("vector").cast("array<double>").alias("b")), "word-vectors")
        self.inverse = np.linalg.inv(gram(self.words, size) + ridge * np.eye(size))

    def infer(self, tokens: DataFrame, key: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
        """``(key, vector)`` of any documents, seen in training or not. Words are
        counted in each document first; only distinct ones meet their vectors.
        Documents are stored as word numbers: ``tokens`` is not read after the call."""
        each = self.words.groupBy("word").agg(*[F.sum(F.col("b")[j]).alias(f"s{j}") for j in range(self.size)])
        strips = stage(coded.strips(self.words.select("word"), max(1, -(-self.words.count() // STRIP_WORDS))), "strips")
        numbers = coded.numbers(strips)
        values = each.join(numbers, "word").select(F.col("id").alias("word"), F.array(*[f"s{j}" for j in range(self.size)]).alias("value"))
        lookup = stage(values, "word-values")
        docs = coded.documents(tokens, numbers, key, tokens_col)
        docs = docs.select(key, F.array_remove("ids", -1).alias("ids"))
        inverse = self.inverse

        def summed(keys: int, run: np.ndarray, row: np.ndarray, n: np.ndarray, values: np.ndarray) -> list[pa.Array]:
            if not len(row):
                return [_lists(np.zeros((keys, len(inverse))))]
            return [_lists(dealt.run_sums(run, values[row] * np.log1p(n)[:, None], keys) @ inverse)]

        kind = tokens.schema[key].dataType.simpleString()
        found = dealt.by_key(docs, lookup, key, "ids", summed, f"`{key}` {kind}, vector array<double>", [key, "vector"])
        zero = F.array_repeat(F.lit(0.0), self.size)
        return found.select(key, F.when(F.col(key).isNull(), zero).otherwise(F.col("vector")).alias("vector"))


def train_documents(spark: SparkSession, tokens: DataFrame, options: dict | None = None, key: str = "doc_id",
                    tokens_col: str = "tokens") -> tuple[DocumentModel, DataFrame]:
    """The model of the documents' words, and the documents' vectors."""
    model = DocumentModel(train_subspace(tokens, options, tokens_col), model_options(options)["vectorSize"])
    return model, model.infer(tokens, key, tokens_col)
