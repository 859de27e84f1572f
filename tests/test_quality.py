from quire.operators import quality
from tests.conftest import text_df

CLEAN = "Under grey skies the ferry crossed, carrying barrels, mail and several tired musicians toward harbour lights."
NOISE = "Blorvint quasked drimmolt, fessual gronnepik tharvole; wumblisk prendolat sneff murgatine vostrellic."
TINY = "ox elm up sky so we ran far by ten and saw two big old elk"
WORDS = "under grey skies ferry crossed carrying barrels mail several tired musicians toward harbour lights".split()


def _dictionary(spark, words):
    return spark.createDataFrame([(w,) for w in words], ["word"])


def test_quality_filter(spark):
    docs = text_df(spark, [("clean", CLEAN), ("noise", NOISE), ("tiny", TINY)])
    dic = _dictionary(spark, WORDS)
    scores = quality.quality_scores(docs, dic)
    kept = {r["doc_id"] for r in quality.quality_filter(docs, dic).collect()}
    assert kept == {"clean"}
    # the document of short words has no long tokens: not scored, not counted
    assert {r["doc_id"] for r in scores.collect()} == {"clean", "noise"}
    s = quality.quality_summary(scores).first()
    assert (s["total_files"], s["good_files"], s["pct_good"]) == (2, 1, 50.0)


def test_whole_texts_are_judged_and_the_window_is_an_option(spark):
    text = " ".join(["harbour"] * 400 + ["zzzzz"] * 1000)
    docs, dic = text_df(spark, [("d", text)]), _dictionary(spark, ["harbour"])
    whole = quality.quality_scores(docs, dic).first()
    assert (whole["n_tokens"], whole["n_good"]) == (2, 1)
    window = quality.quality_scores(docs, dic, words_to_examine=quality.REFERENCE_WINDOW).first()
    assert (window["n_tokens"], window["n_good"]) == (1, 1)


def test_stored_dictionary_gives_the_same(spark):
    from quire.session import stage
    docs, dic = text_df(spark, [("clean", CLEAN), ("noise", NOISE)]), _dictionary(spark, WORDS)
    a = quality.quality_scores(docs, dic).collect()
    b = quality.quality_scores(docs, stage(dic), stored=True).collect()
    assert sorted(a) == sorted(b)
