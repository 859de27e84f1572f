"""Line edits and per-document stopwords on small texts."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import cleaning, filters
from tests.conftest import text_df

ELEVEN = "Box 1 Folder 12\n" + "".join(f"line {i}\n" for i in range(1, 11))
TWO = "Box 1 Folder 12\nline 1\n"
EIGHT = "".join(f"line {i}\n" for i in range(1, 9))
THIRTEEN = "".join(f"line {i}\n" for i in range(1, 14))


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_gentle_archival_trim(spark):
    df = text_df(spark, [("bad", ELEVEN), ("very_bad", TWO), ("good", EIGHT)])
    out = _texts(cleaning.remove_marked_front(df))
    assert out == {"bad": "line 10\n", "very_bad": "", "good": EIGHT}


def test_harsh_archival_drop(spark):
    df = text_df(spark, [("bad", ELEVEN), ("very_bad", TWO), ("good", EIGHT)])
    assert set(_texts(cleaning.drop_marked(df))) == {"good"}


def test_marker_does_not_cross_lines(spark):
    df = text_df(spark, [("x", "Box 1\nFolder 2\n")])
    assert set(_texts(cleaning.drop_marked(df))) == {"x"}


def test_frontmatter(spark):
    df = text_df(spark, [("long", THIRTEEN), ("short", EIGHT)])
    assert _texts(cleaning.remove_frontmatter(df, 10)) == {"long": "line 11\nline 12\nline 13\n", "short": ""}
    strict = _texts(cleaning.filter_frontmatter(df, 7))
    assert set(strict) == {"long", "short"}
    assert strict["short"] == "line 8\n"
    assert set(_texts(cleaning.filter_frontmatter(df, 8))) == {"long"}


def test_transcription_attribution(spark):
    changed = ("Dear sister, the parcel came.\n\nTranscribed and reviewed by contributors participating in "
               "the By The People project at crowd.loc.gov\n")
    df = text_df(spark, [("changed", changed), ("unchanged", "Dear sister, the parcel came.\n")])
    out = _texts(cleaning.remove_matching_lines(df))
    assert {k: " ".join(v.split()) for k, v in out.items()} == {
        "changed": "Dear sister, the parcel came.", "unchanged": "Dear sister, the parcel came."}
    counts = cleaning.edit_counts(df).first()
    assert counts["attribution_lines"] == 1 and counts["attribution_docs"] == 1


def test_location_stopwords(spark):
    """Whole words only: "observer" goes, "observers" stays; a location of
    several words never matches a single token."""
    text = "seven observers met the observer near dayton and sailed from new orleans in a harbor fog"
    docs = text_df(spark, [("page", text), ("nometa", text)])
    meta = spark.createDataFrame([("page", "Harbor Observer (Dayton, Oh.)", ["dayton", "new orleans"])],
                                 "doc_id string, title string, locations array<string>")
    meta = meta.select("doc_id", cleaning.metadata_stopwords(F.col("title"), F.col("locations")).alias("stop"))
    out = _texts(cleaning.remove_document_stopwords(docs.join(meta, "doc_id", "left"), "stop"))
    assert out["page"] == "seven observers met the near and sailed from new orleans in a fog"
    assert out["nometa"] == text


def test_stopwords_keep_repeats(spark):
    docs = spark.createDataFrame([("d", "the cat the cat dog", ["dog"])], "doc_id string, text string, stop array<string>")
    assert _texts(cleaning.remove_document_stopwords(docs, "stop"))["d"] == "the cat the cat"


def test_collection_blocklist_case_insensitive(spark):
    docs = text_df(spark, [("a", ""), ("b", ""), ("c", "")])
    meta = spark.createDataFrame(
        [("a", ["directory of us newspapers in american libraries", "chronicling america"]),
         ("b", ["Civil War"]), ("c", None)], "doc_id string, collections array<string>")
    kept = {r["doc_id"] for r in filters.collection_blocklist(docs, meta, ["Chronicling America"]).collect()}
    assert kept == {"b", "c"}


def test_tokenize_matches_python_split(spark):
    samples = ["Hello,  World!\nIt's\tme", "  ", "", "a\x1cb　c", "ÉCOLE d'été"]
    df = spark.createDataFrame([(s,) for s in samples], ["text"])
    got = [r[0] for r in df.select(T.tokenize("text")).collect()]
    import string
    want = [s.translate(str.maketrans("", "", string.punctuation)).lower().split() for s in samples]
    assert got == want


def test_word_count_and_empty(spark):
    df = text_df(spark, [("a", "one two  three"), ("b", ""), ("c", "   ")])
    wc = {r["doc_id"]: r["n"] for r in df.select("doc_id", T.word_count("text").alias("n")).collect()}
    assert wc == {"a": len("one two  three".split(" ")), "b": 1, "c": 4}
    assert set(_texts(cleaning.drop_empty(df))) == {"a", "c"}


def test_stopword_cases(spark):
    rows = [("a", "The cat, the hat; THE bat. cat", ["the", "bat", "x", "y"]),
            ("b", "only stopwords here", ["only", "stopwords", "here"]),
            ("c", "No metadata, at all", None),
            ("d", "", ["a", "b", "c"]),
            ("e", "one\u00a0two\u2003three", ["two"])]
    docs = spark.createDataFrame(rows, "doc_id string, text string, stop array<string>")
    assert _texts(cleaning.remove_document_stopwords(docs, "stop")) == {
        "a": "cat hat cat", "b": "", "c": "No metadata, at all", "d": "", "e": "one three"}


def test_long_title_is_linear(spark):
    import time
    words = " ".join(f"w{i}" for i in range(60_000))
    docs = spark.createDataFrame([("d", words + " keep", words.split())], "doc_id string, text string, stop array<string>")
    t = time.time()
    assert _texts(cleaning.remove_document_stopwords(docs, "stop")) == {"d": "keep"}
    assert time.time() - t < 20
