"""Order-preserving packing of tokenised documents into windows.

The documents of an input partition form one stream of tokens in row order. A
window is a run of at most ``size`` tokens of it; the windows' cuts are chosen
by dynamic programming over the cut places: document ends, sentence ends (known
from the token itself) and, only where sentences are too long, every
``HARD_STEP`` tokens. A window costs its padding plus a constant; a cut costs
nothing at a document end, ``SENTENCE_COST`` at a sentence end and
``HARD_COST`` elsewhere, the penalty of truncating a document there. A window
is padded to ``size``, but one whose length is a power of two needs no padding.

    best(j) = cut(j) + min( min over i within size of best(i) + padding(i, j),
                            min over powers of two of best(j - 2^k) ) + window

The first inner minimum is over a sliding range of best(i) + position(i), kept
in a monotone queue; the second looks up at most 12 places.

Scale. No shuffle: every partition packs its own rows in the order in which
the scan delivers them, so a retried task repeats its result. Tokens are held
for ``CHUNK_TOKENS`` at a time (or one document): windows are settled up to a
few windows before the chunk's end, the rest goes on with the next chunk.
``sequence_id`` is partition number * 2^40 + a running number.

Tokens. Ids are those of the ``tokenizers`` file, then ``END`` for the end of
the document. The same vocabulary as ``tiktoken`` ranks is about four times as
fast; it is used for texts whose characters both libraries are tested to split
alike (below U+0250 and general punctuation, no overlong runs), and any other
text goes through ``tokenizers``. A worker process builds both once.

Edge cases: a null or empty text is the single id ``END``; a text longer than a
window continues in the next; repeated rows and null keys are packed like any
row; no rows give no windows; columns besides key and text are ignored.
"""

from __future__ import annotations

import base64
import os
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import map_rows, quoted

SIZE = 2048
END = 1                   # id that closes a document
SENTENCE_COST = 4.0       # in tokens of padding
HARD_COST = 64.0
WINDOW_COST = 64.0        # keeps tiny windows from being free
HARD_GAP, HARD_STEP = 512, 64
CHUNK_TOKENS = 1 << 20
SETTLE_WINDOWS = 8        # windows at a chunk's end that the next chunk decides
OUT = "start long, length long, doc_tokens long, sequence_id long, offset long, sequence_length long, " \
      "padded_length long, ids binary"

#: Characters beyond those that both libraries split alike (see tests).
UNCOMMON = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]")
LONGEST_RUN = 255         # bytes of words or of blanks in a row; longer runs go the other way
LEAD = 0xC9               # first byte of U+0240 and up; texts of smaller bytes hold no uncommon character
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the vocabulary's own


class Tokenizer:
    """Ids of a text, without added special tokens."""

    def __init__(self, name: str = "byte_bpe_50k", folder: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task owns one core
        import tiktoken
        import tokenizers

        def path(file: str) -> str:
            if folder:
                return os.path.join(folder, file)
            import public_tokenizers
            return public_tokenizers.path(file)

        self.full = tokenizers.Tokenizer.from_file(path(f"{name}.json"))
        self.full.no_truncation()
        self.full.no_padding()
        special = {t.content: i for i, t in self.full.get_added_tokens_decoder().items()}
        with open(path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.fast = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        # a token that holds a line end, or ends like a sentence, closes one
        self.closes = np.zeros(max(self.full.get_vocab_size(), *ranks.values()) + 1, dtype=bool)
        for token, i in ranks.items():
            self.closes[i] = b"\n" in token or token.rstrip(b"\"')]").endswith((b".", b"!", b"?"))

    @staticmethod
    def common(text: str) -> bool:
        raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        if not len(raw):
            return True
        blank = raw <= 32
        turns = np.flatnonzero(blank[1:] != blank[:-1])
        longest = max(len(raw) - 1 - turns[-1], turns[0] + 1, np.diff(turns).max(initial=0)) if len(turns) else len(raw)
        return longest <= LONGEST_RUN and (int(raw.max()) < LEAD or not UNCOMMON.search(text))

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.common(text):
            found = self.fast.encode_to_numpy(text, allowed_special="all")
        else:
            found = self.full.encode(text, add_special_tokens=False).ids
        out = np.empty(len(found) + 1, dtype=np.uint32)
        out[:-1], out[-1] = found, END
        return out


@lru_cache(maxsize=2)
def known_tokenizer(name: str, folder: str | None) -> Tokenizer:
    """One tokenizer for all tasks of a Python worker."""
    return Tokenizer(name, folder)


def cut_places(ends: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cut positions (0 first) and their costs, given the positions of
    document ends and sentence ends."""
    soft = np.union1d(ends, sentences)
    gaps = np.diff(np.concatenate([[0], soft]))
    hard = [np.arange(soft[i] - gaps[i] + HARD_STEP, soft[i], HARD_STEP) for i in np.flatnonzero(gaps > HARD_GAP)]
    places = np.union1d(soft, np.concatenate(hard)) if hard else soft
    cost = np.full(len(places), HARD_COST)
    cost[np.searchsorted(places, sentences)] = SENTENCE_COST
    cost[np.searchsorted(places, ends)] = 0.0
    return np.concatenate([[0], places]), np.concatenate([[0.0], cost])


def choose_cuts(places: np.ndarray, cost: np.ndarray, size: int = SIZE) -> list[int]:
    """Window bounds (first and last place included) of least total cost; on a
    tie the longest last window."""
    n = len(places)
    exact: dict[int, list[int]] = {}
    step = 1
    while step <= size:
        at = np.searchsorted(places, places - step)
        for j in np.flatnonzero(places[at] == places - step).tolist():
            exact.setdefault(j, []).append(int(at[j]))
        step *= 2
    pos, pen = places.tolist(), (cost + WINDOW_COST).tolist()
    best, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # best + position, position, place
    for j in range(1, n):
        p = pos[j]
        while queue[0][1] < p - size:
            queue.popleft()
        low, _, i = queue[0]
        b = low + size - p
        if j in exact:
            for k in exact[j]:
                if best[k] < b:
                    b, i = best[k], k
        b += pen[j]
        best[j], back[j] = b, i
        b += p
        while queue and queue[-1][0] > b:
            queue.pop()
        queue.append((b, p, j))
    bounds, j = [n - 1], n - 1
    while j:
        j = back[j]
        bounds.append(j)
    return [pos[j] for j in reversed(bounds)]


class Packer:
    """Packs one partition's stream of documents, chunk by chunk."""

    def __init__(self, closes: np.ndarray, first_id: int, size: int = SIZE):
        self.closes, self.next_id, self.size = closes, first_id, size
        self.parts: list[tuple] = []  # (key, start, ids, document's tokens)
        self.held = 0

    def add(self, key, ids: np.ndarray) -> Iterator[dict]:
        self.parts.append((key, 0, ids, len(ids)))
        self.held += len(ids)
        if self.held >= CHUNK_TOKENS:
            yield self.flush(False)

    def flush(self, last: bool) -> dict:
        """Pieces of the settled windows, as columns."""
        keys, starts, ids, totals = zip(*self.parts)
        stream = np.concatenate(ids)
        lens = np.array([len(x) for x in ids])
        ends = np.cumsum(lens)
        places, cost = cut_places(ends, np.flatnonzero(self.closes[stream]) + 1)
        bounds = np.array(choose_cuts(places, cost, self.size))
        if not last:
            bounds = bounds[:max(2, len(bounds) - SETTLE_WINDOWS)]
        done = int(bounds[-1])
        cuts = np.union1d(bounds, ends[ends < done])
        lo, hi = cuts[:-1], cuts[1:]
        doc = np.searchsorted(ends, lo, side="right")
        window = np.searchsorted(bounds, lo, side="right") - 1
        length = np.diff(bounds)
        alone = (length & (length - 1)) == 0
        raw = stream.astype("<u4").tobytes()
        first = ends - lens
        out = {
            "key": [keys[d] for d in doc.tolist()],
            "start": np.array(starts)[doc] + lo - first[doc], "length": hi - lo, "doc_tokens": np.array(totals)[doc],
            "sequence_id": self.next_id + window, "offset": lo - bounds[window], "sequence_length": length[window],
            "padded_length": np.where(alone, length, self.size)[window],
            "ids": [raw[4 * a:4 * b] for a, b in zip(lo.tolist(), hi.tolist())],
        }
        self.next_id += len(length)
        rest = [(k, s + max(0, done - f), x[max(0, done - f):], t)
                for k, s, x, t, f, e in zip(keys, starts, ids, totals, first.tolist(), ends.tolist()) if e > done]
        self.parts, self.held = rest, len(stream) - done
        return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
         tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> DataFrame:
    """One row per piece: the key, the piece's place in its document (``start``,
    ``length`` of ``doc_tokens``) and in its window (``sequence_id``,
    ``offset``), the window's length without and with padding, and the ids as
    little-endian unsigned 32-bit numbers."""
    rows = docs.select(quoted(key), quoted(text))
    kind = rows.schema[0].dataType

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_tokenizer(tokenizer, folder)
        packer = Packer(known.closes, TaskContext.get().partitionId() << 40, size)
        for batch in batches:
            key_type = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                for out in packer.add(k, known.ids(t.as_py())):
                    yield to_batch(out, key_type)
        if packer.parts:
            yield to_batch(packer.flush(True), key_type)

    def to_batch(out: dict, key_type: pa.DataType) -> pa.RecordBatch:
        cols = [pa.array(out["key"], key_type), *[pa.array(out[c]) for c in list(out)[1:-1]],
                pa.array(out["ids"], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=[key, *list(out)[1:]])

    return map_rows(rows, task, f"{quoted(key)} {kind.simpleString()}, {OUT}")
