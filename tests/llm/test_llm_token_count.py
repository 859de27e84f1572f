"""Token counts against the library."""

import random

import pytest

from quire.llm import token_count as T

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    path = public_tokenizers.path(T.MODEL)
    return T.counter(path), sentencepiece.SentencePieceProcessor(model_file=path)


CASES = ["", " ", "  ", "a", " a", "a ", "  a  b   c    ", "\n\n", "a\n\tb", "<s>x</s><unk><0x0A>", "▁a ▁", "é É ß",
         "日本語テキスト", "😀😀 x", "a\x00b", "ﬁ①Å é", " " * 100 + "x", "x" * 500, "ab" * 30_000, "　  "]


def test_cases_match_library(both):
    mine, theirs = both
    for t in CASES:
        assert mine.count(t) == len(theirs.encode(t)), t


def test_random_texts_match_library(both):
    mine, theirs = both
    rng = random.Random(4)
    chars = [chr(c) for c in range(0x250)] + [chr(c) for c in range(0x2000, 0x2070)] + list("中文😀▁") + \
        [" "] * 150 + list("etaoinshrdlu") * 40
    for _ in range(3000):
        t = "".join(rng.choices(chars, k=rng.randint(0, 60)))
        assert mine.count(t) == len(theirs.encode(t)), t


def test_cache_is_bounded(both, monkeypatch):
    mine, theirs = both
    monkeypatch.setattr(T, "CACHE_SEGMENTS", 5)
    fresh = T.PieceCounter(public_tokenizers.path(T.MODEL))
    text = "these are many different words with several lengths"
    assert fresh.count(text) == len(theirs.encode(text)) and len(fresh) <= 5


def test_rows(spark, both):
    _, theirs = both
    rows = [(i, t, "x") for i, t in enumerate(CASES)] + [(None, None, None), (0, "again", "x"), (0, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens string")
    got = T.count_tokens(df)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens"]
    for r in got.collect():
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(theirs.encode(r.text or "")))
    assert T.count_tokens(df.limit(0)).collect() == []
