"""File-tree and landed-JSON sources (SRC-1..13, FLT-9, FLT-12, SNK-8).

The reference walks directories of one-file-per-document text and JSON.
These readers turn such trees into DataFrames with Spark's file sources:
whole-file text reads, recursive lookup with glob filters, and the hidden
``_metadata.file_path`` column for keys. Malformed JSON never fails a job:
it becomes a row of a reject table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import keys
from ..session import path_exists

# Layout of a page text: <root>/<lccn/yyyy/mm/dd/ed-n/seq-n>/ocr.txt
PAGE_FILE_RE = r"/([\w/-]+)/ocr\.txt$"

# Folders on one level from which on tasks list them, each with all that is below it
LISTED_BY_DRIVER = 8

METADATA_RECORD = T.StructType([
    T.StructField("collections", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("subjects", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("subject_headings", T.ArrayType(T.StringType())),
    T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("states", T.ArrayType(T.StringType())),
    T.StructField("keyword_scores", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("date", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image_url", T.StringType()),
])
METADATA_FILE = T.MapType(T.StringType(), METADATA_RECORD)

ITEM = T.StructType([
    T.StructField("partof", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()), T.StructField("url", T.StringType())]))),
    T.StructField("title", T.StringType()),
    T.StructField("subjects", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("subject_headings", T.ArrayType(T.StringType())),
    T.StructField("location", T.ArrayType(T.StringType())),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("date", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image_url", T.ArrayType(T.StringType())),
])
ITEM_RESPONSE = T.StructType([T.StructField("item", ITEM), T.StructField("status", T.LongType())])

SEARCH_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("access_restricted", T.BooleanType()),
        T.StructField("online_format", T.ArrayType(T.StringType())),
        T.StructField("language", T.ArrayType(T.StringType())),
        T.StructField("subject", T.ArrayType(T.StringType())),
        T.StructField("image_url", T.ArrayType(T.StringType())),
        T.StructField("date", T.StringType()),
    ]))),
    T.StructField("pagination", T.StructType([
        T.StructField("next", T.StringType()), T.StructField("of", T.LongType())])),
])


def _local_path(p: str) -> str:
    """A local path made absolute; anything with a scheme stays as it is."""
    return p.rstrip("/") if re.match(r"[a-zA-Z][\w+.-]*:", p) else os.path.abspath(p).rstrip("/")


def _file_path():
    # _metadata.file_path is a URI (file:/..., s3a://...); strip the scheme
    # and authority so that keys are stable across file systems, and undo the
    # URI's escapes ("%20"; a plus sign is no escape in a path)
    path = F.regexp_replace(F.col("_metadata.file_path"), r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "")
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _rel(root: str):
    root_path = re.sub(r"^[a-zA-Z][\w+.-]*:(//[^/]*)?", "", _local_path(root))
    return F.regexp_replace(_file_path(), "^" + re.escape(root_path) + "/?", "")


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Deep trees are listed by one job near their root with a few tasks for each slot.
    By Spark's defaults the first level of more than 32 folders is listed by tasks: of
    page trees that are the last folders, with a job for each title and year and a
    task, whose result goes to the driver, for nearly every file."""
    name = "spark.sql.sources.parallelPartitionDiscovery."
    few = {f"{name}threshold": str(LISTED_BY_DRIVER), f"{name}parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in few}
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_pages(spark: SparkSession, root: str, dir_regex: str | None = None, lccns: tuple[str, ...] | None = None,
               years: tuple[int, int] | None = None) -> DataFrame:
    """SRC-1 / FLT-6..9: page texts under ``root``; only ``*.txt`` files (``.xml``
    twins are skipped) at ``<key>/ocr.txt``. ``dir_regex`` (e.g. ``/1877/``),
    ``lccns`` and ``years`` (both ends inclusive) further select pages. All of them,
    and later filters on ``doc_id`` or ``path``, depend on the file's name alone, so
    Spark applies them to the file listing and opens only the files left."""
    with _few_listing_tasks(spark):  # files are listed here, not when the rows are read
        df = spark.read.text(_local_path(root), wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt")
    rel = _rel(root)
    out = df.select(F.regexp_extract(F.concat(F.lit("/"), rel), PAGE_FILE_RE, 1).alias("doc_id"),
                    F.lit("page").alias("kind"), F.col("value").alias("text"), rel.alias("path"))
    out = out.where(F.col("doc_id") != "")
    if dir_regex:
        out = out.where(F.col("path").rlike(dir_regex))
    if lccns is not None:
        out = out.where(keys.identifier("doc_id").isin(*lccns))
    if years is not None:
        out = out.where(F.substring(keys.page_date("doc_id"), 1, 4).try_cast("int").between(*years))
    return out


def read_items(spark: SparkSession, results_dir: str) -> DataFrame:
    """SRC-2: item texts ``results/*`` (not recursive); key = file name."""
    df = spark.read.text(_local_path(results_dir), wholetext=True)
    path = _file_path()
    return df.select(F.element_at(F.split(path, "/"), -1).alias("doc_id"), F.lit("item").alias("kind"),
                     F.col("value").alias("text"), _rel(results_dir).alias("path"))


def read_corpus(spark: SparkSession, newspaper_dir: str | None = None, results_dir: str | None = None,
                dir_regex: str | None = None) -> DataFrame:
    """SRC-3 / SET-1: pages and items as one table. An item landed twice keeps
    one row per key (the reference overwrote the file)."""
    parts = []
    if newspaper_dir:
        parts.append(read_pages(spark, newspaper_dir, dir_regex))
    if results_dir:
        parts.append(read_items(spark, results_dir).dropDuplicates(["doc_id"]))
    if not parts:
        raise ValueError("no corpus directory given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_binary_texts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """FLT-12: files read as bytes; ``(good, undecodable)`` -- the second is
    the list of files left untouched because they are not valid UTF-8."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_local_path(root))
    rel = _rel(root)
    ok = F.is_valid_utf8(F.col("content"))
    good = df.where(ok).select(rel.alias("path"), F.col("content").cast("string").alias("text"))
    bad = df.where(~ok).select(rel.alias("path"), F.lit("not valid UTF-8").alias("reason"))
    return good, bad


def read_identifiers(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: identifier CSV; header skipped, values trimmed, blanks dropped."""
    df = spark.read.csv(_local_path(path), header=True, schema="identifier STRING")
    return df.select(F.trim("identifier").alias("identifier")).where(F.col("identifier") != "")


def identifiers_from_texts(corpus: DataFrame) -> DataFrame:
    """SRC-5: identifiers of texts already landed."""
    return corpus.select(F.col("doc_id").alias("identifier")).distinct()


def read_metadata(spark: SparkSession, metadata_dir: str) -> tuple[DataFrame, DataFrame]:
    """SRC-6: metadata JSON files ``{identifier: record}``.

    Returns ``(records, rejects)``: records carry ``doc_key`` (path below the
    metadata root), ``identifier`` and the record fields; files that do not
    parse land in ``rejects(doc_key, reason)`` instead of failing the job."""
    raw = spark.read.text(_local_path(metadata_dir), wholetext=True, recursiveFileLookup=True)
    parsed = raw.select(_rel(metadata_dir).alias("doc_key"),
                        F.from_json("value", METADATA_FILE, {"mode": "PERMISSIVE"}).alias("m"))
    empty = F.coalesce(F.size("m"), F.lit(0)) <= 0
    rejects = parsed.where(empty).select(
        "doc_key", F.when(F.col("m").isNull(), F.lit("malformed metadata")).otherwise(F.lit("no record"))
        .alias("reason"))
    records = (parsed.where(~empty)
               .select("doc_key", F.explode("m").alias("identifier", "r"))
               .select("doc_key", "identifier", "r.*"))
    return records, rejects


def read_search_results(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: landed search-result pages -> one row per result."""
    pages = spark.read.json(_local_path(path), schema=SEARCH_PAGE, multiLine=True)
    return pages.select(F.explode("results").alias("r")).select("r.*")


def read_item_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-8: landed raw item JSON, one file per identifier (the file's name
    without ``.json``).
    ``(items, rejects)``; a response without ``item`` or with an error status
    is rejected (SNK-8)."""
    raw = spark.read.text(_local_path(path), wholetext=True, recursiveFileLookup=True)
    name = F.regexp_replace(F.element_at(F.split(_file_path(), "/"), -1), r"(?i)\.json$", "")
    parsed = raw.select(name.alias("identifier"), F.from_json("value", ITEM_RESPONSE).alias("j"))
    bad = F.col("j").isNull() | F.col("j.item").isNull() | (F.coalesce(F.col("j.status"), F.lit(200)) >= 400)
    items = parsed.where(~bad).select("identifier", F.col("j.item").alias("item"))
    rejects = parsed.where(bad).select("identifier", F.lit("no item in response").alias("reason"))
    return items, rejects


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: 2-D coordinates CSV, first row skipped."""
    return spark.read.csv(_local_path(path), header=True, schema="x DOUBLE, y DOUBLE")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: a word list (one word per line, or a parquet ``word`` table)."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path).select("word").distinct()
    return (spark.read.text(_local_path(path)).select(F.trim("value").alias("word"))
            .where(F.col("word") != "").distinct())


def read_corrections(spark: SparkSession, root: str, model_id: str) -> DataFrame | None:
    """SRC-13: the correction table derived with a given model, if any."""
    path = f"{root.rstrip('/')}/{model_id}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_dataset(spark: SparkSession, landing_root: str, definition) -> DataFrame:
    """SRC-9: the search results that make up a data set.

    Each part of the ``DatasetDefinition`` is a directory of landed search
    pages under ``landing_root``; results are kept by the usable-results
    filter (FLT-1), date-filtered parts also by the year window (FLT-20),
    and items listed by identifier are added. One row per result, tagged
    with its part; a result reached through two parts is kept once."""
    from ..operators.filters import usable_results
    frames = []
    for name, dated in definition.parts():
        r = usable_results(read_search_results(spark, f"{landing_root.rstrip('/')}/{name}"))
        if dated:
            lo, hi = definition.collection_years
            r = r.where(F.substring("date", 1, 4).try_cast("int").between(lo, hi))
        frames.append(r.withColumn("part", F.lit(name)))
    if definition.items:
        frames.append(spark.createDataFrame([(i,) for i in definition.items], "id string")
                      .withColumn("part", F.lit("items")))
    if not frames:
        raise ValueError("empty data set definition")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.dropDuplicates(["id"])


def select_newspaper_pages(pages: DataFrame, selection, batch_edges: DataFrame | None = None) -> DataFrame:
    """SRC-9 newspapers part on landed pages: keep the selected titles (all
    when none are named) whose page year lies in the window (FLT-8, both ends
    inclusive); with ``batch_edges(lccn, batch)`` and ``selection.count``, only
    titles covered by the first ``count`` needed batches (ORD-3)."""
    from ..operators import batches as B
    out = pages.withColumn("lccn", keys.identifier("doc_id"))
    year = F.substring(keys.page_date("doc_id"), 1, 4).try_cast("int")
    out = out.where(year.between(selection.first_year, selection.last_year))
    if selection.lccns:
        out = out.where(F.col("lccn").isin(*selection.lccns))
    if batch_edges is not None and selection.count is not None:
        wanted = out.select("lccn").distinct()
        first = B.first_batches(B.needed_batches(wanted, batch_edges), selection.count)
        covered = batch_edges.join(first, "batch", "left_semi").select("lccn").distinct()
        out = out.join(covered, "lccn", "left_semi")
    return out.drop("lccn")
