import json

from pyspark.sql import functions as F

from quire.functions import keys
from quire.functions import metadata as M
from quire.functions import text as T
from quire.operators import batches as B
from quire.operators import filters, stats
from quire.operators import metadata as meta_ops


def test_batch_listings_and_coverage(spark):
    listing = spark.read.json(spark.sparkContext.parallelize([json.dumps(
        {"batches": [{"name": "batch_a", "lccns": ["sn1", "sn2"]}, {"name": "batch_b", "lccns": ["sn2"]},
                     {"name": "batch_a", "lccns": ["sn1"]}], "next": None})]))
    edges = B.edges_from_listing(listing)
    assert sorted(tuple(r) for r in edges.collect()) == [("sn1", "batch_a"), ("sn2", "batch_a"), ("sn2", "batch_b")]
    mm = {r["lccn"]: r["batchs"] for r in B.multimap(edges, "lccn", "batch").collect()}
    assert mm == {"sn1": ["batch_a"], "sn2": ["batch_a", "batch_b"]}
    inv = {r["batch"]: r["lccns"] for r in B.multimap(edges, "batch", "lccn").collect()}
    assert inv == {"batch_a": ["sn1", "sn2"], "batch_b": ["sn2"]}
    titles = spark.read.json(spark.sparkContext.parallelize([json.dumps(
        {"items": [{"id": "https://x.gov/lccn/sn1/"}, {"id": "https://x.gov/lccn/sn9/"}, {"id": "nolccn"}],
         "endIndex": 3, "totalItems": 3})]))
    assert sorted(r["lccn"] for r in B.titles_from_listing(titles).collect()) == ["sn1", "sn9"]
    ocr = spark.read.json(spark.sparkContext.parallelize([json.dumps(
        {"ocr": [{"name": "batch_a.tar.bz2", "url": "https://x.gov/data/batch_a.tar.bz2"}]})]))
    urls = B.ocr_batches(ocr)
    assert [tuple(r) for r in urls.collect()] == [("batch_a", "https://x.gov/data/batch_a.tar.bz2")]
    assert urls.select(B.batch_name(F.col("url"))).first()[0] == "batch_a"
    wanted = spark.createDataFrame([("sn2",), ("sn3",)], ["lccn"])
    cov = B.coverage(wanted, edges, urls).first().asDict()
    assert cov == {"titles_wanted": 2, "titles_available": 1, "batches_needed": 2,
                   "batches_found": 1, "batches_not_found": 1}
    assert [r["batch"] for r in B.first_batches(B.needed_batches(wanted, edges), 1).collect()] == ["batch_a"]


def test_key_helpers(spark):
    df = spark.createDataFrame([("/data/news/sn1/1870/01/02/ed-1/seq-4/ocr.txt",), ("https://loc/item/x1/",)], ["p"])
    got = [r[0] for r in df.select(keys.doc_key("p", "/data/news")).collect()]
    assert got == ["sn1/1870/01/02/ed-1/seq-4", "https://loc/item/x1"]
    assert [r[0] for r in df.select(keys.last_segment("p")).collect()] == ["ocr.txt", "x1"]


def test_metadata_helpers(spark):
    df = spark.createDataFrame([(None, [], {"k": {"a": 1}}, "k")],
                               "loc array<string>, img array<string>, m map<string,map<string,int>>, id string")
    r = df.select(M.dedup_locations("loc").alias("l"), M.first_image("img").alias("i"),
                  M.unwrap("m", "id").alias("u"), T.title_words(F.lit(None).cast("string")).alias("t")).first()
    assert (r["l"], r["i"], r["u"], r["t"]) == ([], None, {"a": 1}, [])


def test_metadata_joins_and_year_backfill(spark):
    docs = spark.createDataFrame([("a",), ("b",)], ["doc_id"])
    meta = spark.createDataFrame([("a", "1870-05-01", None), ("c", "1901", "1901")],
                                 "doc_id string, date string, year string")
    joined, missing = meta_ops.documents_with_metadata(docs, meta)
    assert [r["doc_id"] for r in joined.collect()] == ["a"]
    assert [r["doc_id"] for r in missing.collect()] == ["b"]
    assert meta_ops.with_metadata(docs, meta).count() == 2
    years = {r["doc_id"]: r["year"] for r in meta_ops.backfill_year(meta, docs).collect()}
    assert years == {"a": "1870", "c": "1901"}


def test_filters_misc(spark):
    res = spark.createDataFrame([
        ("https://www.loc.gov/item/1/", False, ["online text"], ["english"]),
        ("https://blogs.loc.gov/2/", False, ["online text"], ["english"]),
        ("not a url", False, ["online text"], ["english"]),
        ("https://www.loc.gov/item/3/", None, ["online text"], ["english"]),
        ("https://www.loc.gov/item/4/", False, None, ["english"]),
        ("https://www.loc.gov/item/5/", False, ["online text"], ["spanish"])],
        "id string, access_restricted boolean, online_format array<string>, language array<string>")
    kept = [r["id"] for r in filters.usable_results(res).collect()]
    assert kept == ["https://www.loc.gov/item/1/", "not a url"]
    paths = spark.createDataFrame([("a/1877/x",), ("a/1876/x",)], ["path"])
    assert filters.path_filter(paths, "/1877/").count() == 1
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    sample = filters.systematic_sample(ids, 1000)
    assert 0 < sample.count() < 10
    years = spark.createDataFrame([(1864,), (1865,), (1877,), (1878,)], ["y"])
    assert [r["y"] for r in filters.year_range(years, F.col("y"), *filters.NEWSPAPER_YEARS).collect()] == [1865, 1877]


def test_value_counts_orders_by_frequency(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), (None,)], "s array<string>")
    got = [(r["value"], r["count"]) for r in stats.value_counts(df, "s").collect()]
    assert got == [("a", 2), ("b", 1), (None, 1)]
