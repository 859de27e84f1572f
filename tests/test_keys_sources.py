import json

from pyspark.sql import functions as F

from quire.functions import keys
from quire.functions import metadata as M
from quire.operators import layout
from quire.operators import metadata as meta_ops
from quire.sources import files, sinks

PAGE = "sn90017345/1871/05/06/ed-1/seq-3"


def test_page_key_functions(spark):
    df = spark.createDataFrame([(f"/data/newspapers/{PAGE}/ocr.txt",), ("results/abc1200034",),
                                ("https://www.loc.gov/item/abc1200034/",)], ["k"])
    rows = df.select(keys.kind("k").alias("kind"), keys.identifier("k").alias("id"),
                     keys.page_date("k").alias("date"), keys.page_url("k").alias("url"),
                     keys.last_segment("k").alias("file")).collect()
    assert rows[0]["kind"] == "page" and rows[0]["id"] == "sn90017345"
    assert rows[0]["date"] == "1871-05-06"
    assert rows[0]["url"] == "https://chroniclingamerica.loc.gov/lccn/sn90017345/1871-05-06/ed-1/seq-3/"
    assert (rows[1]["kind"], rows[1]["id"]) == ("item", "abc1200034")
    assert rows[2]["file"] == "abc1200034"
    thumb = spark.createDataFrame([("https://x.org/a/b",), ("https://x.org/a/b/",)], ["u"]) \
        .select(keys.thumbnail_url("u").alias("t")).collect()
    assert [r["t"] for r in thumb] == ["https://x.org/a/b/thumbnail.jpg"] * 2


def test_item_metadata_projection(spark):
    item = {"partof": [{"title": "river gazettes of the north",
                        "url": "https://www.loc.gov/collections/river-gazettes/"},
                       {"title": "reading room", "url": "https://www.loc.gov/rr/x/"}],
            "title": "Ohio Ferryman", "location": ["marietta", "ohio", "lower landing", "ohio"],
            "date": "1877", "url": "https://www.loc.gov/item/sn90017345/", "image_url": ["a.gif", "b.gif"]}
    raw = spark.createDataFrame([(PAGE, json.dumps({"item": item})), ("abc1200034", json.dumps({"item": item})),
                                 ("missing", json.dumps({"status": 404}))], ["identifier", "value"])
    items = raw.select("identifier", F.from_json("value", files.ITEM_RESPONSE)["item"].alias("item")) \
        .where(F.col("item").isNotNull()).withColumn("identifier", keys.identifier("identifier"))
    ids = spark.createDataFrame([(PAGE,), ("abc1200034",), ("nothing1",)], ["identifier"])
    records, rejects = meta_ops.fetch_metadata(ids, items)
    recs = {r["doc_key"]: r for r in records.collect()}
    page = recs[PAGE]
    assert page["collections"] == ["river gazettes of the north"]
    assert sorted(page["locations"]) == ["lower landing", "marietta", "ohio"]
    assert page["states"] == ["Ohio"]
    assert page["date"] == "1871-05-06" and page["year"] == "1871"
    assert page["url"] == "https://chroniclingamerica.loc.gov/lccn/sn90017345/1871-05-06/ed-1/seq-3"
    assert page["image_url"] == page["url"] + "/thumbnail.jpg"
    assert page["keyword_scores"] == {}
    it = recs["abc1200034"]
    assert (it["date"], it["year"], it["image_url"]) == ("1877", "1877", "a.gif")
    assert [r["doc_key"] for r in rejects.collect()] == ["nothing1"]


def test_states_fused_names_fixed(spark):
    df = spark.createDataFrame([(["arkansas", "california", "new york", "paris"],)], ["l"])
    got = df.select(M.states_in(F.col("l")).alias("s")).first()["s"]
    assert sorted(got) == ["Arkansas", "California", "New York"]


def _tree(tmp_path):
    root = tmp_path / "newspapers"
    for key, text in [("sn91004321/1869/12/30/ed-1/seq-1", "page one"),
                      ("sn91004321/1877/01/02/ed-1/seq-2", "page two")]:
        d = root / key
        d.mkdir(parents=True)
        (d / "ocr.txt").write_text(text)
        (d / "ocr.xml").write_text("<xml/>")
    res = tmp_path / "results"
    res.mkdir()
    (res / "abd2000011").write_text("item one")
    (res / "abd2000012").write_text("item two")
    meta = tmp_path / "metadata"
    (meta / "sn91004321/1869/12/30/ed-1").mkdir(parents=True)
    (meta / "sn91004321/1869/12/30/ed-1/seq-1").write_text(json.dumps(
        {"sn91004321": {"title": "The Landing Herald", "locations": ["marietta"], "date": "1869-12-30",
                        "keyword_scores": {"war": -3}}}))
    (meta / "abd2000012").write_text(json.dumps({"abd2000012": {"title": "Item", "date": "1863"}}))
    (meta / "broken").write_text("{not json")
    return root, res, meta


def test_file_sources(spark, tmp_path):
    root, res, meta = _tree(tmp_path)
    pages = {r["doc_id"]: r["text"] for r in files.read_pages(spark, str(root)).collect()}
    assert pages == {"sn91004321/1869/12/30/ed-1/seq-1": "page one", "sn91004321/1877/01/02/ed-1/seq-2": "page two"}
    only_1877 = files.read_pages(spark, str(root), dir_regex="/1877/").collect()
    assert [r["doc_id"] for r in only_1877] == ["sn91004321/1877/01/02/ed-1/seq-2"]
    corpus = files.read_corpus(spark, str(root), str(res))
    assert corpus.count() == 4
    assert {r["doc_id"] for r in corpus.where("kind = 'item'").collect()} == {"abd2000011", "abd2000012"}
    records, rejects = files.read_metadata(spark, str(meta))
    recs = {r["identifier"]: r for r in records.collect()}
    assert recs["sn91004321"]["keyword_scores"] == {"war": -3}
    assert recs["sn91004321"]["doc_key"] == "sn91004321/1869/12/30/ed-1/seq-1"
    assert recs["abd2000012"]["year"] is None
    assert [r["doc_key"] for r in rejects.collect()] == ["broken"]


def test_csv_sources_and_positional_zip(spark, tmp_path):
    ids = tmp_path / "ids.csv"
    ids.write_text("lccn\n sn90017345/1871/05/06/ed-1/seq-3 \nabc1200034\n")
    got = [r["identifier"] for r in files.read_identifiers(spark, str(ids)).collect()]
    assert got == [PAGE, "abc1200034"]
    coords = tmp_path / "coords.csv"
    coords.write_text("x\ty\n-5.25e+00,4.5e+00\n1.0,2.0\n3.0,4.0\n")
    c = files.read_coordinates(spark, str(coords))
    assert c.count() == 3
    zipped = layout.zip_positional(c, files.read_identifiers(spark, str(ids))).collect()
    assert len(zipped) == 2                          # truncated to the shorter
    assert {(round(r["x"], 3), r["identifier"]) for r in zipped} == {(-5.25, PAGE), (1.0, "abc1200034")}


def test_incremental_write_and_invalid_utf8(spark, tmp_path):
    out = str(tmp_path / "stage")
    df = spark.createDataFrame([("a", 1), ("b", 2)], ["k", "v"])
    sinks.write_new_only(df, out, "k")
    sinks.write_new_only(spark.createDataFrame([("b", 20), ("c", 3)], ["k", "v"]), out, "k")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 2), ("c", 3)]
    d = tmp_path / "bin"
    d.mkdir()
    (d / "ok.txt").write_bytes("héllo".encode())
    (d / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    good, bad = files.read_binary_texts(spark, str(d))
    assert [r["text"] for r in good.collect()] == ["héllo"]
    assert [r["path"] for r in bad.collect()] == ["bad.txt"]


def test_dataset_definition_and_title_allow_list(spark, tmp_path):
    from quire.config import DatasetDefinition
    from quire.operators import filters
    page = {"results": [
        {"id": "https://www.loc.gov/item/a/", "access_restricted": False, "online_format": ["online text"],
         "language": ["english"], "date": "1870"},
        {"id": "https://blogs.loc.gov/x/", "access_restricted": False, "online_format": ["online text"],
         "language": ["english"], "date": "1870"},
        {"id": "https://www.loc.gov/item/b/", "access_restricted": True, "online_format": ["online text"],
         "language": ["english"], "date": "1870"},
        {"id": "https://www.loc.gov/item/c/", "access_restricted": False, "online_format": ["online text"],
         "language": ["english"], "date": "1901"}],
        "pagination": {"next": None, "of": 4}}
    for name in ("civil-war", "reconstruction"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "p1.json").write_text(json.dumps(page))
    d = DatasetDefinition(collections=("civil-war",), date_filtered_collections=("reconstruction",),
                          items=("mss1",))
    got = {(r["id"], r["part"]) for r in files.read_dataset(spark, str(tmp_path), d).collect()}
    ids = {i for i, _ in got}
    assert ids == {"https://www.loc.gov/item/a/", "https://www.loc.gov/item/c/", "mss1"}
    titles = spark.createDataFrame([("The Daily Dispatch",), ("Evening Star",), ("Other",)], ["title"])
    kept = [r["title"] for r in filters.title_allow_list(titles, ["daily dispatch", "EVENING"]).collect()]
    assert sorted(kept) == ["Evening Star", "The Daily Dispatch"]


def test_select_newspaper_pages(spark):
    from quire.config import NewspaperSelection
    pages = spark.createDataFrame([
        ("sn1/1864/01/01/ed-1/seq-1", "a"), ("sn1/1865/01/01/ed-1/seq-1", "b"),
        ("sn2/1877/12/31/ed-1/seq-2", "c"), ("sn3/1870/05/05/ed-1/seq-1", "d"),
        ("sn2/1878/01/01/ed-1/seq-1", "e")], ["doc_id", "text"])
    got = files.select_newspaper_pages(pages, NewspaperSelection(lccns=("sn1", "sn2")))
    assert sorted(r["text"] for r in got.collect()) == ["b", "c"]
    edges = spark.createDataFrame([("sn1", "batch_b"), ("sn2", "batch_a"), ("sn3", "batch_c")], ["lccn", "batch"])
    first = files.select_newspaper_pages(pages, NewspaperSelection(count=1), edges)
    assert sorted(r["text"] for r in first.collect()) == ["c"]       # batch_a covers sn2 only


def test_escaped_paths_and_json_names(spark, tmp_path):
    d = tmp_path / "results"
    d.mkdir()
    (d / "two words+100%").write_text("text")
    assert [r["doc_id"] for r in files.read_items(spark, str(d)).collect()] == ["two words+100%"]
    j = tmp_path / "json"
    j.mkdir()
    (j / "abc1.json").write_text(json.dumps({"item": {"title": "t"}}))
    items, rejects = files.read_item_json(spark, str(j))
    assert [r["identifier"] for r in items.collect()] == ["abc1"] and rejects.count() == 0


def test_every_metadata_file_is_a_record_or_a_reject(spark, tmp_path):
    d = tmp_path / "metadata"
    d.mkdir()
    (d / "empty").write_text("{}")
    (d / "broken").write_text("{")
    (d / "good").write_text(json.dumps({"good": {"title": "t"}}))
    records, rejects = files.read_metadata(spark, str(d))
    assert [r["doc_key"] for r in records.collect()] == ["good"]
    assert {r["doc_key"]: r["reason"] for r in rejects.collect()} == {
        "empty": "no record", "broken": "malformed metadata"}


def test_dates_that_are_no_numbers(spark, tmp_path):
    from quire.config import DatasetDefinition
    d = tmp_path / "dated"
    d.mkdir()
    res = [{"id": f"https://example.org/{i}", "access_restricted": False, "online_format": ["online text"],
            "language": ["english"], "date": date} for i, date in enumerate(["n.d.", "1870-01-01", None])]
    (d / "p.json").write_text(json.dumps({"results": res}))
    got = files.read_dataset(spark, str(tmp_path), DatasetDefinition(date_filtered_collections=("dated",)))
    assert [r["date"] for r in got.collect()] == ["1870-01-01"]


def test_collections_need_every_url(spark):
    rows = [([("a", "x/collections/a"), ("b", None)],), ([("a", "x/collections/a"), ("b", "y")],), ([],), (None,)]
    df = spark.createDataFrame(rows, "partof array<struct<title:string,url:string>>")
    got = [r["c"] for r in df.select(M.collections_from_partof("partof").alias("c")).collect()]
    assert got == [None, ["a"], [], None]


def test_pages_of_one_title_share_its_record(spark):
    pages = spark.range(500).select(F.concat(F.lit("sn90017345/1871/05/"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"),
                                             F.lit("/ed-1/seq-"), (F.col("id") % 9).cast("string")).alias("identifier"))
    item = spark.createDataFrame([("sn90017345", json.dumps({"item": {"title": "t"}}))], ["identifier", "v"]).select(
        "identifier", F.from_json("v", files.ITEM_RESPONSE)["item"].alias("item"))
    records, rejects = meta_ops.fetch_metadata(pages, item.union(item))
    assert records.count() == pages.distinct().count() and rejects.count() == 0


def test_paths_with_a_scheme_are_left_alone(spark, tmp_path):
    (tmp_path / "words").write_text("one\n two \n\none\n")
    for path in (str(tmp_path / "words"), f"file:{tmp_path}/words", f"file://{tmp_path}/words"):
        assert sorted(r["word"] for r in files.read_dictionary(spark, path).collect()) == ["one", "two"]


def test_identifiers_of_landed_texts(spark, tmp_path):
    root, res, _ = _tree(tmp_path)
    got = files.identifiers_from_texts(files.read_corpus(spark, str(root), str(res)))
    assert {r["identifier"] for r in got.collect()} == {
        "sn91004321/1869/12/30/ed-1/seq-1", "sn91004321/1877/01/02/ed-1/seq-2", "abd2000011", "abd2000012"}


def _opened(df):
    """Rows of ``df`` and the number of files that its scan opens."""
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        n = plan.execute().count()
        return n, plan.collectLeaves().head().metrics().apply("numFiles").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_page_filters_choose_files_before_they_are_opened(spark, tmp_path):
    root = str(tmp_path / "tree")
    rows = [(f"b/sn{t}/{y}/01/02/ed-1/seq-1/ocr.{ext}", f"{t} {y}") for t in range(3) for y in range(1870, 1880)
            for ext in ("txt", "xml")]
    sinks.write_text_files(spark.createDataFrame(rows, "path string, text string"), root)
    assert _opened(files.read_pages(spark, root)) == (30, 30)
    assert _opened(files.read_pages(spark, root, "/1877/")) == (3, 3)
    assert _opened(files.read_pages(spark, root, years=(1872, 1874))) == (9, 9)
    assert _opened(files.read_pages(spark, root, "/187[0-4]/", ("sn0", "sn2"), (1873, 1879))) == (4, 4)
    assert files.read_pages(spark, root, lccns=()).count() == 0
    assert _opened(files.read_pages(spark, root).where("doc_id LIKE '%sn1/1871%'")) == (1, 1)


def test_page_trees_are_listed_by_few_tasks(spark, tmp_path):
    """Many folders with a page each, below few titles and years."""
    root = str(tmp_path / "tree")
    rows = [(f"b/data/sn{t}/{y}/01/02/ed-1/seq-{n}/ocr.txt", f"{t} {y} {n}") for t in range(10) for y in (1870, 1871)
            for n in range(40)]
    sinks.write_text_files(spark.createDataFrame(rows, "path string, text string"), root)
    spark.sparkContext.setJobGroup("listing", "listing")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold")
    pages = files.read_pages(spark, root)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("listing")]
    assert sum(status.getStageInfo(i).numTasks for j in jobs for i in j.stageIds) <= 10
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.threshold") == before
    assert pages.count() == 800 and {r["text"] for r in pages.collect()} == {t for _, t in rows}


def test_text_files_written_and_written_again(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([("a/x.txt", "one\ntwo\n"), ("b c.txt", None), (None, "lost"), ("a/y.txt", "é")],
                               "path string, text string")
    for place in (root, "file://" + root, root):
        sinks.write_text_files(df, place)
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes().decode() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {"a/x.txt": "one\ntwo\n", "b c.txt": "", "a/y.txt": "é"}
    sinks.write_text_files(df.limit(0), str(tmp_path / "none"))


def test_rejects_are_found_without_the_items(spark, capsys):
    """no item is compared or moved for the rejects; an item that is null is missing."""
    ids = spark.createDataFrame([("sn1",), ("sn2",), ("sn3",), ("sn3",)], ["identifier"])
    raw = spark.createDataFrame([("sn1", '{"item": {"title": "t"}}'), ("sn1", None), ("sn2", None), (None, '{"item": {}}')],
                                "identifier string, value string")
    items = raw.select("identifier", F.from_json("value", files.ITEM_RESPONSE)["item"].alias("item"))
    _, rejects = meta_ops.fetch_metadata(ids, items)
    assert sorted(r["doc_key"] for r in rejects.collect()) == ["sn2", "sn3"]
    rejects.explain()
    plan = capsys.readouterr().out
    assert "max_by" not in plan and "to_json" not in plan
