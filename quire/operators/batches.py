"""Newspaper batch graph (SRC-14..16, JN-8, JN-9, AGG-8, AGG-9, AGG-12,
SET-2, ORD-3, FN-19).

The reference keeps ``dict[lccn, set[batch]]`` and its inverse in memory.
Here the many-to-many relation is the edge table ``(lccn, batch)``, distinct;
a multimap is that table read by either key, and its sizes are counts. Arrays
per key are an export (``multimap``) for keys of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: batch name inside an OCR tarball URL.
BATCH_NAME_RE = r"/([\w_]+)\.tar\.bz2"


def edges_from_listing(batches_page: DataFrame) -> DataFrame:
    """SRC-14: batch listing pages -> distinct ``(lccn, batch)`` edges (all pages, D6)."""
    b = batches_page.select(F.explode("batches").alias("b"))
    return (b.select(F.col("b.name").alias("batch"), F.explode("b.lccns").alias("lccn"))
            .select("lccn", "batch").distinct())


def titles_from_listing(titles_page: DataFrame) -> DataFrame:
    """SRC-15: title listing pages -> distinct lccn (id pattern ``/lccn/(\\w+)/``)."""
    items = titles_page.select(F.explode("items").alias("it"))
    return (items.select(F.regexp_extract("it.id", r"/lccn/(\w+)/", 1).alias("lccn"))
            .where(F.col("lccn") != "").distinct())


def ocr_batches(ocr_listing: DataFrame) -> DataFrame:
    """SRC-16: OCR batch listing -> ``(batch, url)``, name cut at the first '.'."""
    o = ocr_listing.select(F.explode("ocr").alias("o"))
    return o.select(F.split(F.col("o.name"), r"\.").getItem(0).alias("batch"), F.col("o.url").alias("url"))


def batch_name(url) -> F.Column:
    """FN-19: batch name from a tarball URL."""
    return F.regexp_extract(url, BATCH_NAME_RE, 1)


def degrees(edges: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-8 / AGG-9: how many distinct values every key has, and the first and
    last of them (use the other column order for the inversion). Pre-aggregated
    map-side; no key's values are gathered."""
    return (edges.select(key, value).distinct().groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("first"), F.max(value).alias("last")))


def multimap(edges: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-8 / AGG-9 as an export: ``key -> sorted distinct values`` in one
    array, for keys known to have few values."""
    return edges.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(value + "s"))


def needed_batches(wanted: DataFrame, edges: DataFrame) -> DataFrame:
    """JN-8 / SET-2: distinct union of the batch sets of the wanted titles."""
    return edges.join(wanted.select("lccn").distinct(), "lccn", "left_semi").select("batch").distinct()


def batch_downloads(needed: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JN-9: needed batches with their URL, and the unmatched ones (logged)."""
    found = needed.join(urls, "batch", "inner")
    missing = needed.join(urls, "batch", "left_anti")
    return found, missing


def first_batches(batches: DataFrame, count: int | None) -> DataFrame:
    """ORD-3: the first ``count`` batches by name (all when ``count`` is None, D5)."""
    ordered = batches.orderBy("batch")
    return ordered.limit(count) if count is not None else ordered


def coverage(wanted: DataFrame, edges: DataFrame, urls: DataFrame) -> DataFrame:
    """AGG-12: wanted titles, those with any batch, batches needed, found and
    not found -- one row from one aggregate over a tagged union of the two
    grains (titles and batches); no join of single-row results."""
    w = wanted.select("lccn").distinct()
    titles = (w.join(edges.select("lccn").distinct().withColumn("_hit", F.lit(True)), "lccn", "left")
              .select(F.lit("title").alias("_kind"), F.col("_hit").isNotNull().alias("_hit")))
    need = needed_batches(w, edges)
    found = (need.join(urls.select("batch").distinct().withColumn("_hit", F.lit(True)), "batch", "left")
             .select(F.lit("batch").alias("_kind"), F.col("_hit").isNotNull().alias("_hit")))
    rows = titles.unionByName(found)
    is_title = F.col("_kind") == "title"
    is_batch = F.col("_kind") == "batch"
    return rows.agg(
        F.count_if(is_title).alias("titles_wanted"),
        F.count_if(is_title & F.col("_hit")).alias("titles_available"),
        F.count_if(is_batch).alias("batches_needed"),
        F.count_if(is_batch & F.col("_hit")).alias("batches_found"),
        F.count_if(is_batch & ~F.col("_hit")).alias("batches_not_found"))
