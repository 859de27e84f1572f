import json

from pyspark.sql import functions as F

from quire.operators import layout
from quire.sources import sinks
from quire.streaming import cleaning_stream as S

GOOD = "the school opened for the session with pupils and teachers"
BAD = "lorem ipsum dolor amet consectetur adipiscing"


def test_stream_quality_filter_is_rerunnable(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([(1, GOOD), (2, BAD)], "doc_id long, text string").write.parquet(str(src / "a"))
    dic = spark.createDataFrame([(w,) for w in "school opened session pupils teachers with".split()], ["word"])
    schema = spark.read.parquet(str(src / "a")).schema
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    S.quality_filter_batches(S.read_documents_stream(spark, str(src / "a"), schema), dic, sink, ckpt)
    assert [r["doc_id"] for r in spark.read.parquet(sink).collect()] == [1]
    # a rerun with the same checkpoint processes nothing new
    S.quality_filter_batches(S.read_documents_stream(spark, str(src / "a"), schema), dic, sink, ckpt)
    assert spark.read.parquet(sink).count() == 1


def test_stream_clean_matches_batch(spark, tmp_path):
    src = tmp_path / "docs"
    rows = [(1, "keep me\nBox 1 Folder 2\n"), (2, "x\nREMOVE THIS\ny"), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    stream = S.read_documents_stream(spark, str(src), schema)
    sink = str(tmp_path / "clean")
    S.run_to_parquet(S.clean(stream, r"Box [0-9]+[ \t]+Folder [0-9]+", "REMOVE THIS"), sink, sink + "-ckpt")
    got = {r["doc_id"]: r["text"] for r in spark.read.parquet(sink).collect()}
    assert got == {2: "x\ny"}


def test_labelled_csv_and_metadata_json(spark, tmp_path):
    coords = spark.createDataFrame([("a", 1.5, -2.0)], "doc_id string, x double, y double")
    meta = spark.createDataFrame(
        [("a", ["c1", "c2"], "Title, with comma", ["ohio"], "1870", {"war": 3})],
        "doc_id string, collections array<string>, title string, locations array<string>, "
        "date string, keyword_scores map<string,int>")
    lab = layout.labelled_table(coords, meta, ["war", "peace"])
    out = str(tmp_path / "csv")
    sinks.write_labelled_csv(lab, out)
    back = spark.read.csv(out, header=True).first()
    assert back["collections"] == '["c1","c2"]' and back["title"] == "Title, with comma"
    assert back["war"] == "3" and back["peace"] is None and back["date"] == "1870"
    assert lab.columns[:3] == ["doc_id", "x", "y"] and lab.columns[3] == "collections"
    recs = meta.withColumnRenamed("doc_id", "identifier")
    jpath = str(tmp_path / "json")
    sinks.write_metadata_json(recs, jpath)
    line = spark.read.text(jpath).first()["value"]
    assert json.loads(line)["a"]["keyword_scores"] == {"war": 3}


def test_stream_replace_nonwords(spark, tmp_path):
    src = tmp_path / "docs"
    spark.createDataFrame([(1, '"Skives" is a word. fdahlj is not.')], "doc_id long, text string") \
        .write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    dic = spark.createDataFrame([(w,) for w in ["is", "a", "word", "not", "slaves"]], ["word"])
    corr = spark.createDataFrame([("skives", "slaves", 0.9)], "nonword string, good_word string, similarity double")
    sink = str(tmp_path / "out")
    S.replace_nonwords_batches(S.read_documents_stream(spark, str(src), schema), dic, corr, sink, sink + "-ckpt")
    assert [r["text"] for r in spark.read.parquet(sink).collect()] == ["slaves is a word is not"]


def test_bucketed_stages_join_without_shuffle(spark, tmp_path, capsys):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") * 2).alias("a"))
    meta = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") * 3).alias("b"))
    sinks.write_bucketed(docs, "quire_test_docs", "doc_id", 4, str(tmp_path / "docs"))
    sinks.write_bucketed(meta, "quire_test_meta", "doc_id", 4, str(tmp_path / "meta"))
    # large-table conditions: no broadcast, so the bucketed layout decides
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        joined = spark.table("quire_test_docs").join(spark.table("quire_test_meta"), "doc_id")
        capsys.readouterr()
        joined.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS quire_test_docs")
        spark.sql("DROP TABLE IF EXISTS quire_test_meta")


def test_labelled_header_without_key(spark):
    coords = spark.createDataFrame([("a", 1.0, 2.0)], "doc_id string, x double, y double")
    meta = spark.createDataFrame([("a", "T", {"war": 1})], "doc_id string, title string, keyword_scores map<string,int>")
    lab = layout.labelled_table(coords, meta, ["war"], include_key=False)
    from quire.functions import metadata as M
    assert lab.columns == ["x", "y", *M.METADATA_ORDER, "war"]


def test_unreadable_output_is_never_replaced(spark, tmp_path):
    import pytest

    from quire.sources import sinks
    path = str(tmp_path / "out")
    spark.createDataFrame([("a", 1), ("b", 2)], "other string, v int").write.parquet(path)
    new = spark.createDataFrame([("c", 3)], "doc_id string, v int")
    with pytest.raises(ValueError):
        sinks.write_new_only(new, path, "doc_id")
    assert spark.read.parquet(path).count() == 2
    fresh = str(tmp_path / "fresh")
    sinks.write_new_only(new, fresh, "doc_id")
    sinks.write_new_only(new, fresh, "doc_id")
    assert spark.read.parquet(fresh).count() == 1


def test_reject_log_of_a_rerun_replaces_the_old(spark, tmp_path):
    from quire.sources import sinks
    path = str(tmp_path / "rejects")
    df = spark.createDataFrame([("a", "r")], "doc_key string, reason string")
    sinks.write_rejects(df, path)
    sinks.write_rejects(df, path)
    assert spark.read.parquet(path).count() == 1


def test_cluster_needs_a_shared_folder():
    from quire.session import is_local_master
    assert is_local_master("local[4]") and is_local_master("local")
    assert not is_local_master("local-cluster[2,1,1024]") and not is_local_master("yarn")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    import pytest

    from quire.session import ensure_checkpoint_dir
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_table_stream_reads_a_folder_of_files_and_a_single_file(spark, tmp_path):
    from quire.plans import cleaning_queries as Q
    df = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    folder, single = tmp_path / "folder", tmp_path / "single"
    df.repartition(3).write.parquet(str(folder / "documents.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    single.mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(single / "documents.parquet")
    for place in (folder, single):
        got = {r["doc_id"]: r["text"] for r in Q.q_stream_clean(spark, str(place)).collect()}
        assert got == {i: f"text {i}" for i in range(6)}
    # nothing left: an empty table, not an error
    gone = tmp_path / "gone"
    df.where("doc_id < 0").write.parquet(str(gone / "documents.parquet"))
    assert Q.q_stream_clean(spark, str(gone)).collect() == []
