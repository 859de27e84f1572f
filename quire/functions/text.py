"""Text projections as Spark Column expressions (TXT-1..18, FN-14..17).

All of these are JVM-side expressions (string functions plus higher-order
array functions), so they run inside whole-stage codegen and work the same on
batch and streaming DataFrames.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- Fixed values (must equal the reference's for identical results) ---
# The 32 ASCII punctuation characters removed by depunctuation (Python's
# string.punctuation): !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
PUNCTUATION = string.punctuation
# Archival folder marker line: "Box <n> <blanks> Folder <n>" (blanks exclude
# the newline so that the pattern stays inside one line).
ARCHIVAL_MARKER_RE = r"Box [0-9]+[ \t\x0B\f\r]+Folder [0-9]+"
# Crowd-transcription attribution line (a regex: '.' matches any character).
TRANSCRIPTION_ATTRIBUTION = (
    "Transcribed and reviewed by contributors participating in the "
    "By The People project at crowd.loc.gov"
)
# --- end of fixed values ---

# Python's str.split() splits on Unicode whitespace plus the ASCII
# information separators 0x1C-0x1F, which Java's (?U)\s leaves out.
WHITESPACE_RE = r"(?U)[\s\x1c-\x1f]+"


HELD_TAILS = 1 << 16  # positions that a task has as text, and hashes at once


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def depunctuate(c: ColumnOrName) -> Column:
    """TXT-1: delete the ASCII punctuation characters."""
    return F.translate(_col(c), PUNCTUATION, "")


def normalize(c: ColumnOrName) -> Column:
    """TXT-2: lower-case, then depunctuate."""
    return depunctuate(F.lower(_col(c)))


def split_ws(c: ColumnOrName) -> Column:
    """Split on runs of whitespace, dropping empty pieces (Python ``split()``).
    ``array_remove`` is a native (code-generated) expression, unlike a lambda
    filter, and this sits on the hottest path."""
    return F.array_remove(F.split(_col(c), WHITESPACE_RE), "")


def tokenize(c: ColumnOrName) -> Column:
    """TXT-3: depunctuate, lower, split on any whitespace, no empty tokens."""
    return split_ws(normalize(c))


def without_words(tokens: ColumnOrName, words: Iterable[str]) -> Column:
    """Drop tokens that are in a fixed word list, keeping repeats and order.

    ``isin`` with more than a handful of literals becomes a hash-set lookup,
    so this stays O(tokens) per row.
    """
    words = sorted(set(words))
    if not words:
        return _col(tokens)
    return F.filter(_col(tokens), lambda w: ~w.isin(*words))


def filter_stopwords(text: ColumnOrName, stopwords: Iterable[str]) -> Column:
    """TXT-4: stopword removal on the raw text, before tokenising.

    Case- and punctuation-sensitive because it runs first, as in the
    reference. Returns the text re-joined with single spaces.
    """
    return F.array_join(without_words(split_ws(text), stopwords), " ")


def preprocess(text: ColumnOrName, stopwords: Iterable[str] | None = None,
               stopword_filter=None, tokenizer=None) -> Column:
    """TXT-5: tokenize(filter_stopwords(text)); both steps replaceable (UDF-1/2)."""
    text = _col(text)
    if stopword_filter is not None:
        text = stopword_filter(text)
    elif stopwords:
        text = filter_stopwords(text, stopwords)
    return (tokenizer or tokenize)(text)


# Alphabetic run: word characters that are not digits.
ALPHABETIC_RE = r"(?U)((?:(?!\d)\w)+)"


def simple_tokens(c: ColumnOrName, min_len: int = 2, max_len: int = 15) -> Column:
    """TXT-6: alternate tokeniser: lower-cased alphabetic runs of
    ``min_len``..``max_len`` characters, none starting with '_'."""
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(ALPHABETIC_RE), 1)
    return F.filter(runs, lambda w: (F.length(w) >= min_len) & (F.length(w) <= max_len)
                    & ~w.startswith("_"))


def default_stopwords(spark=None) -> list[str]:
    """Spark's built-in English stopword list (the library default for TXT-4;
    it differs from the reference's list, which is not available here)."""
    from pyspark.ml.feature import StopWordsRemover
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def lines(c: ColumnOrName) -> Column:
    """Split into lines on ``\\n``; a trailing newline yields a final ``''``."""
    return F.split(_col(c), "\n", -1)


def drop_first_lines(c: ColumnOrName, n: int = 10) -> Column:
    """TXT-7: delete the first ``n`` lines (``sed 1,nd``); short text -> ''."""
    ls = lines(c)
    return F.array_join(F.slice(ls, n + 1, F.greatest(F.size(ls) - n, F.lit(0))), "\n")


def has_marker_line(c: ColumnOrName, line_regex: str = ARCHIVAL_MARKER_RE) -> Column:
    """True when some line of the text matches ``line_regex``.

    A regex search over the whole text equals a per-line search as long as
    the pattern cannot match a newline (the default marker cannot).
    """
    return _col(c).rlike(line_regex)


def count_matching_lines(c: ColumnOrName, line_regex: str) -> Column:
    """Number of lines matching ``line_regex`` (what ``grep | wc -l`` counts)."""
    return F.size(F.filter(lines(c), lambda ln: ln.rlike(line_regex)))


def drop_matching_lines(c: ColumnOrName, line_regex: str = TRANSCRIPTION_ATTRIBUTION) -> Column:
    """TXT-10: delete every line matching ``line_regex`` (``sed /re/d``)."""
    return F.array_join(F.filter(lines(c), lambda ln: ~ln.rlike(line_regex)), "\n")


def word_count(c: ColumnOrName) -> Column:
    """TXT-17: ``len(text.split(' '))`` -- single-space split, empties counted."""
    return F.size(F.split(_col(c), " ", -1))


def long_tokens(tokens: ColumnOrName, min_len: int = 4) -> Column:
    """FLT-17: tokens of at least ``min_len`` characters."""
    return F.filter(_col(tokens), lambda w: F.length(w) >= min_len)


def title_words(title: ColumnOrName) -> Column:
    """TXT-11: normalised whitespace words of a title; [] when null/empty."""
    return F.coalesce(F.transform(split_ws(title), lambda w: normalize(w)),
                      F.array().cast("array<string>"))


def normalized_list(xs: ColumnOrName) -> Column:
    """TXT-12: normalise each element as a whole string; null list -> []."""
    return F.coalesce(F.transform(_col(xs), lambda w: normalize(w)),
                      F.array().cast("array<string>"))


def lower_list(xs: ColumnOrName) -> Column:
    """FN-14: lower-case every element."""
    return F.transform(_col(xs), lambda w: F.lower(w))


def _position_sampler(seed: int):
    """Of ``n`` positions the ``k`` of the least md5 of ``prefix``, position and seed, in
    the order of (md5, position). Built here, so that tasks need not import this module."""
    def hashes(head: bytes, tails: list[bytes]) -> bytes:
        return b"".join([md5(head + t).digest() for t in tails])

    def chosen(head: bytes, n: int, k: int, tails: list[bytes]) -> list[int]:
        if k <= 0:
            return []
        digests = [hashes(head, tails[:n])]
        for at in range(HELD_TAILS, n, HELD_TAILS):
            digests.append(hashes(head, [f"{i}/{seed}".encode() for i in range(at, min(n, at + HELD_TAILS))]))
        high, low = np.frombuffer(b"".join(digests), ">u8").astype("u8").reshape(-1, 2).T
        near = np.arange(n)
        if k < n:  # the others have a greater first half
            near = np.flatnonzero(high <= np.partition(high, k - 1)[k - 1])
        return near[np.lexsort((near, low[near], high[near]))][:k].tolist()

    def positions(prefix: pd.Series, n: pd.Series, k: pd.Series) -> pd.Series:
        none = n.isna() | k.isna()
        sizes = n.mask(none, 0).astype("int64").tolist()
        tails = [f"{i}/{seed}".encode() for i in range(min(max(sizes, default=0), HELD_TAILS))]
        return pd.Series([None if gone else chosen(head.encode(), size, int(wanted), tails)
                          for head, size, wanted, gone in zip(prefix, sizes, k, none)], dtype=object)

    return F.pandas_udf(positions, "array<int>")


def sample_tokens(tokens: ColumnOrName, fraction: float, seed: int, *key: ColumnOrName,
                  keep_order: bool = True) -> Column:
    """TXT-16: deterministic sample without replacement of ``bround(n*fraction)``
    tokens. Tokens are ranked by the md5 of (key, position, seed), so the sample
    is reproducible and independent of partitioning. ``fraction=1.0`` keeps all.
    ``keep_order=False`` skips restoring text order (for order-free uses).
    Only the number of tokens goes to Python, which ranks the positions."""
    toks = _col(tokens)
    if fraction >= 1.0:
        return toks
    # as concat_ws has it: a null part leaves no separator
    prefix = F.concat(F.lit(""), *[F.coalesce(F.concat(_col(k).cast("string"), F.lit("/")), F.lit("")) for k in key])
    n = F.size(toks)
    picked = _position_sampler(seed)(prefix, n, F.bround(n * F.lit(float(fraction))).cast("int"))
    if keep_order:
        picked = F.sort_array(picked)
    # one struct, so that the tokens are evaluated once and not for each position
    both = F.array(F.struct(toks.alias("words"), picked.alias("at")))
    return F.transform(both, lambda b: F.transform(b["at"], lambda i: F.get(b["words"], i)))[0]
