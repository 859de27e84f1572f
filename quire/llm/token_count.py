"""Token counts of a SentencePiece BPE vocabulary, by heap-based merging.

The pieces and scores of the model file give each mergeable piece a rank (best
score first). A run of symbols is a linked list; a heap holds its adjacent
pairs by (rank, position). The lowest pair is popped and merged as long as one
is left; a popped entry whose symbols have changed since is skipped. The count
is the number of initial symbols minus the merges; a symbol that no piece
covers counts as its UTF-8 bytes. No identifiers are produced.

Text is prepared as the model file prescribes (this vocabulary: no
normalisation, a leading space added to a text that is not empty, spaces turned
into U+2581). Because the pieces fix which characters may stand next to each
other inside a piece, a text falls apart into segments at every other place: no
merge crosses it, so segments count for themselves. A worker remembers the
counts of short segments, up to ``CACHE_SEGMENTS``.

Scale. One pass, no shuffle; memory is the text in hand and the bounded cache.

Edge cases: a null or empty text has no bytes and no tokens; strings that look
like special tokens are ordinary text; very long runs without any break are one
segment, merged in O(n log n); ``n_bytes`` and ``n_tokens`` replace columns of
those names, all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import packed_row, unpacked_row

MODEL = "piece_bpe_32k.model"
CACHE_SEGMENTS = 1 << 20
CACHE_CHARS = 48          # longer segments are not remembered
SPACE = "▁"
_LOADED: dict[str, "PieceCounter"] = {}  # one per worker process and model


class PieceCounter(dict):
    """segment -> number of tokens."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_preparation(model)
        usable = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        # equal scores are equally good: the leftmost pair goes first
        scores = sorted({model.get_score(i) for i in usable}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        self.rank = {model.id_to_piece(i): place[model.get_score(i)] for i in usable}
        self.byte_fallback = any(model.is_byte(i) for i in range(model.get_piece_size()))
        inside = {p[k:k + 2] for p in self.rank for k in range(len(p) - 1)}
        chars = sorted({c for pair in inside for c in pair})
        # character classes: 0 for those never beside another inside a piece
        self.cls = np.zeros(0x110000, dtype=np.int16)
        self.cls[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for a, b in inside:
            self.joins[self.cls[ord(a)], self.cls[ord(b)]] = True

    def __missing__(self, segment: str) -> int:
        n = self.merge(segment)
        if len(segment) <= CACHE_CHARS:
            if len(self) >= CACHE_SEGMENTS:
                self.clear()
            self[segment] = n
        return n

    def alone(self, char: str) -> int:
        """Tokens of a character that was never merged."""
        return 1 if char in self.rank or not self.byte_fallback else len(char.encode("utf-8"))

    def merge(self, s: str) -> int:
        n, rank = len(s), self.rank
        if n == 1:
            return self.alone(s)
        get = rank.get
        # a symbol is the span from its start to end[start]; begin[e] is the
        # start of the symbol that ends at e: together a doubly linked list
        end, begin = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(s[i:i + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, i, e = heappop(heap)
            mid = end[i]
            if mid < 0 or mid >= n or mid == e or end[mid] != e:
                continue  # a symbol of this pair has been merged since
            end[i], end[mid], begin[e] = e, -1, i
            merges += 1
            if e < n and (r := get(s[i:end[e]])) is not None:
                heappush(heap, (r, i, end[e]))
            if i and (r := get(s[begin[i]:e])) is not None:
                heappush(heap, (r, begin[i], e))
        rest = 0
        if self.byte_fallback:
            i = 0
            while i < n:
                if end[i] == i + 1 and s[i] not in rank:
                    rest += len(s[i].encode("utf-8")) - 1
                i = end[i]
        return n - merges + rest

    def segments(self, text: str) -> list[str]:
        """``text`` cut wherever no piece can hold both neighbours."""
        code = self.cls[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        cuts = (np.flatnonzero(~self.joins[code[:-1], code[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.segments(SPACE + text.replace(" ", SPACE))))


def check_preparation(model) -> None:
    """Refuse a model whose text preparation differs from the one written here."""
    for text in ("a  b", " a ", "\t\n", "ﬁ①Å", "é"):
        if model.decode(model.encode(text)) != text or \
                model.normalize(text).replace(SPACE, " ") not in (" " + text,):
            raise ValueError("the model normalises its text; only plain models are supported")


def counter(path: str) -> PieceCounter:
    if path not in _LOADED:
        _LOADED[path] = PieceCounter(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens``. ``model`` is the model file's
    place on the executors (default: the installed public vocabulary)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        path = model
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(MODEL)
        known = counter(path)
        for texts in batches:
            texts = [t or "" for t in texts]
            yield pd.DataFrame({"n_bytes": [len(t.encode("utf-8")) for t in texts],
                                "n_tokens": [known.count(t) for t in texts]})

    udf = F.pandas_udf(run, "struct<n_bytes:long,n_tokens:long>").asNondeterministic()
    counted = packed_row(docs, text=text).withColumn("found", udf("text"))
    return unpacked_row(counted, docs.columns, n_bytes=F.col("found.n_bytes"), n_tokens=F.col("found.n_tokens"))
