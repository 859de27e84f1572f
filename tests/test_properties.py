"""Property tests: Spark expressions against plain-Python definitions."""

import re
import string

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.functions import text as T

ALPHABET = (string.ascii_letters + string.digits + string.punctuation + " \t\n\r\x0b\x0c\x1c\x1f"
            + "\xa0 　éÉßñÜç")
texts = st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=25)


def _py_tokenize(s):
    return s.translate(str.maketrans("", "", string.punctuation)).lower().split()


def _py_drop_first(s, n):
    # sed '1,nd': delete the first n lines, keep the rest byte for byte
    parts = s.split("\n")
    return "\n".join(parts[n:])


@settings(max_examples=15, deadline=None)
@given(texts)
def test_tokenize_matches_python(spark, samples):
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    got = [r[0] for r in df.select(T.tokenize("text")).collect()]
    assert got == [_py_tokenize(s) for s in samples]


@settings(max_examples=15, deadline=None)
@given(texts, st.integers(min_value=0, max_value=4))
def test_line_edits_match_python(spark, samples, n):
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    rows = df.select(T.drop_first_lines("text", n).alias("a"),
                     T.drop_matching_lines("text", "[0-9]x").alias("b"),
                     T.word_count("text").alias("c")).collect()
    for s, r in zip(samples, rows):
        assert r["a"] == _py_drop_first(s, n)
        assert r["b"] == "\n".join(ln for ln in s.split("\n") if not re.search("[0-9]x", ln))
        assert r["c"] == len(s.split(" "))
