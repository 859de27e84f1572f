from pyspark.sql import functions as F

from quire.config import CorpusConfig
from quire.functions import metadata as M
from quire.plans.end_to_end import MapOptions, corpus_map

WORDS = "river boat water bridge steam cotton market price train station".split()


def test_corpus_map_trains_and_labels(spark):
    docs = [(f"d{i}", " ".join(WORDS[(i + j) % len(WORDS)] for j in range(40)) + "\nBox 1 Folder 2")
            for i in range(12)]
    docs = spark.createDataFrame(docs, ["doc_id", "text"])
    meta = spark.createDataFrame(
        [(f"d{i}", f"The Daily {WORDS[i % 10].title()}", ["ohio"], ["news"]) for i in range(10)],
        "doc_id string, title string, locations array<string>, collections array<string>")
    meta = meta.select("*", M.states_in(F.col("locations")).alias("states"),
                       F.create_map().cast("map<string,int>").alias("keyword_scores"))
    dic = spark.createDataFrame([(w,) for w in WORDS], ["word"])
    cfg = CorpusConfig(model_options={"vectorSize": 8, "minCount": 1})
    opts = MapOptions(keywords=["river", "steam"], archival_lines=0, attribution=r"Box [0-9]+ Folder [0-9]+",
                      tile_size=4)
    out = corpus_map(docs, meta, dic, opts, config=cfg)
    lab = out["labelled"]
    assert lab.columns[:3] == ["doc_id", "x", "y"] and lab.columns[-2:] == ["river", "steam"]
    rows = lab.collect()
    assert len(rows) == 10                                   # two documents lack metadata
    assert all(isinstance(r["river"], int) for r in rows)
    assert {r["states"] for r in rows} == {'["Ohio"]'}
    cleaned = {r["doc_id"]: r["text"] for r in out["documents"].collect()}
    assert all("box" not in t for t in cleaned.values())    # marker lines removed
    assert out["tiles"].count() == 10


def test_config_default_stopwords_and_options(spark):
    cfg = CorpusConfig(epochs=3, model_options={"vectorSize": 20}, training_options={"seed": 7})
    opts = cfg.word2vec_options()
    assert (opts["maxIter"], opts["vectorSize"], opts["seed"], opts["minCount"]) == (3, 20, 7, 25)
    df = spark.createDataFrame([("The cat and the Hat",)], ["text"])
    # Spark's English list drops lower-case "the" and "and" before tokenising;
    # "The" (capitalised) survives and is lower-cased afterwards
    assert df.select(cfg.tokens("text").alias("t")).first()["t"] == ["the", "cat", "hat"]
    assert df.select(CorpusConfig(stopwords=None).tokens("text").alias("t")).first()["t"] == \
        ["the", "cat", "and", "the", "hat"]


def test_cli_map_over_landed_files(spark, tmp_path):
    import json

    from quire.cli import main
    pages = tmp_path / "newspapers"
    meta = tmp_path / "metadata"
    words = "river boat water bridge steam cotton market price train station".split()
    for i in range(8):
        key = f"sn0000000{i}/1870/01/0{i + 1}/ed-1/seq-1"
        (pages / key).mkdir(parents=True)
        text = " ".join(words[(i + j) % 10] for j in range(30))
        (pages / key / "ocr.txt").write_text(f"The Daily Paper\n{text}\n")
        (meta / key).parent.mkdir(parents=True, exist_ok=True)
        (meta / key).write_text(json.dumps({f"sn0000000{i}": {
            "title": "The Daily Paper", "locations": ["ohio"], "collections": ["news"],
            "date": f"1870-01-0{i + 1}", "keyword_scores": {}}}))
    dic = tmp_path / "dictionary.txt"
    dic.write_text("\n".join(words + ["the", "daily", "paper"]))
    out = tmp_path / "out"
    assert main(["map", "--pages", str(pages), "--metadata", str(meta), "--dictionary", str(dic),
                 "--keywords", "river,steam", "--min-count", "1", "--tile-size", "3",
                 "--buckets", "2", "--frontmatter-lines", "1",
                 "--out", str(out)]) == 0
    lab = spark.read.csv(str(out / "labelled_csv"), header=True)
    assert lab.count() == 8 and {"river", "steam", "x", "y", "title"} <= set(lab.columns)
    assert spark.read.parquet(str(out / "tiles")).count() == 8
    kept = spark.read.parquet(str(out / "documents")).collect()
    assert all("daily" not in r["text"] for r in kept)        # the first line of every page is gone


def test_stages_apply_to_their_own_kind(spark):
    """Front matter and location stopwords: pages only. Archival notes and
    attribution lines: items only."""
    body = "river boat water\nBox 1 Folder 2\nTranscribed by many hands\nriver steam ohio"
    docs = spark.createDataFrame([("p", "page", body), ("i", "item", body)], "doc_id string, kind string, text string")
    meta = spark.createDataFrame([("p", "Steam News", ["ohio"], ["c"]), ("i", "Steam News", ["ohio"], ["c"])],
                                 "doc_id string, title string, locations array<string>, collections array<string>")
    meta = meta.select("*", F.create_map().cast("map<string,int>").alias("keyword_scores"))
    dic = spark.createDataFrame([(w,) for w in WORDS + ["folder", "transcribed", "many", "hands", "ohio"]], ["word"])
    opts = MapOptions(keywords=["river"], frontmatter_lines=1, archival_lines=2, attribution="^Transcribed")
    out = corpus_map(docs, meta, dic, opts, config=CorpusConfig(
        stopwords=None, model_options={"vectorSize": 4, "minCount": 1}))
    text = {r["doc_id"]: r["text"] for r in out["documents"].collect()}
    assert text["p"] == "box 1 folder 2 transcribed by many hands river"
    assert text["i"] == "river steam ohio"


def test_map_of_documents_without_known_words(spark):
    """A document with no trained word has a zero vector: on no map, no error."""
    docs = spark.createDataFrame([(f"d{i}", "page", " ".join(WORDS)) for i in range(3)] +
                                 [("odd", "page", "steam market")], "doc_id string, kind string, text string")
    meta = spark.createDataFrame([(f"d{i}", "", [], []) for i in range(3)] + [("odd", "", [], [])],
                                 "doc_id string, title string, locations array<string>, collections array<string>")
    meta = meta.select("*", F.create_map().cast("map<string,int>").alias("keyword_scores"))
    dic = spark.createDataFrame([(w,) for w in WORDS], ["word"])
    vocabulary = [w for w in WORDS if w not in ("steam", "market")]
    wv = spark.createDataFrame([(w, [1.0, float(i)]) for i, w in enumerate(vocabulary)], "word string, vector array<double>")
    from quire.operators import training
    toks = docs.select("doc_id", F.split("text", " ").alias("tokens"))
    out = corpus_map(docs, meta, dic, MapOptions(keywords=["river"], frontmatter_lines=0), word_vectors=wv,
                     doc_vectors=training.mean_vectors(wv, toks, size=2))
    assert {r["doc_id"] for r in out["labelled"].collect()} == {"d0", "d1", "d2"}


def test_configured_corpus_and_vocabulary(spark, tmp_path):
    d = tmp_path / "pages" / "sn00000001" / "1870" / "01" / "01" / "ed-1" / "seq-1"
    d.mkdir(parents=True)
    (d / "ocr.txt").write_text("river river river boat boat steam")
    cfg = CorpusConfig(newspaper_dir=str(tmp_path / "pages"), newspaper_dir_regex="/1870/", stopwords=None,
                       min_frequency=1, model_options={"vectorSize": 4})
    docs = cfg.documents(spark)
    assert [r["kind"] for r in docs.collect()] == ["page"]
    toks = docs.select("doc_id", cfg.tokens("text").alias("tokens"))
    from quire.operators import training, vocab
    words = cfg.training_vocabulary(toks)
    assert {r["word"] for r in words.collect()} == {"river", "boat"}
    model = training.train_distributed(toks, cfg.model(), vocabulary=words)
    assert {r["word"] for r in model.collect()} == {"river", "boat"}
    path = str(tmp_path / "freq")
    vocab.word_frequencies(toks).write.parquet(path)
    saved = CorpusConfig(vocabulary=path, min_frequency=2)
    assert [r["word"] for r in saved.training_vocabulary(toks).collect()] == ["river"]
    assert vocab.vocabulary(spark, saved_path=path, min_frequency=2).count() == 1


def test_random_indexing_matches_a_plain_loop(spark):
    import hashlib
    from quire.operators import training
    docs = [["a", "b", "c", "a", "d"], ["d", "a"], []]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, tokens array<string>")
    size, window = 130, 2

    def sign(w, d):
        block, bit = divmod(d, 128)
        h = hashlib.md5(f"{block}/{w}".encode()).hexdigest()
        return (int(h[bit // 4], 16) >> bit % 4 & 1) * 2 - 1

    want = {w: [0] * size for w in "ad"}
    for t in docs:
        for i, w in enumerate(t):
            for j in range(max(0, i - window), min(len(t), i + window + 1)):
                if j != i and w in want:
                    want[w] = [x + sign(t[j], d) for d, x in enumerate(want[w])]
    got = training.train_distributed(df, {"vectorSize": size, "windowSize": window, "minCount": 2})
    assert {r["word"]: r["vector"] for r in got.collect()} == want


def test_trained_vectors_invariants(spark):
    from quire.operators import training
    words = "river boat water bridge steam cotton".split()
    docs = spark.createDataFrame([(i, [words[(i + j) % 6] for j in range(20)]) for i in range(10)],
                                 "doc_id long, tokens array<string>")
    model = training.train(docs, {"vectorSize": 6, "minCount": 1, "maxIter": 1, "seed": 3}, num_partitions=1)
    wv = {r["word"]: r["vector"] for r in training.word_vectors(model).collect()}
    assert set(wv) == set(words) and all(len(v) == 6 for v in wv.values())
    dv = training.doc_vectors(model, docs).collect()
    assert len(dv) == 10
    import numpy as np
    first = dv[0]
    toks = [words[j % 6] for j in range(20)]
    mean = np.mean([wv[t] for t in toks], axis=0)
    assert np.allclose(first["vector"], mean, atol=1e-5)      # document vector = mean word vector


def test_stopwords_after_tokenize_option(spark):
    df = spark.createDataFrame([("The cat and the Hat",)], ["text"])
    cfg = CorpusConfig(stopwords_after_tokenize=True)
    assert df.select(cfg.tokens("text").alias("t")).first()["t"] == ["cat", "hat"]
