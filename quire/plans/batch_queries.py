"""Batch-graph queries. Fixture mapping: a lineitem's (part, supplier) pair is
a (title, batch) edge; wanted titles are the parts of size <= 10; suppliers
with a positive balance publish an OCR tarball URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batches as B
from ..sources.tables import table
from .registry import register

WANTED_MAX_SIZE = 10
FIRST_N = 25
URL_BASE = "https://example.org/data/batches/"


def title_of(part: str) -> Column:
    return F.concat(F.lit("sn"), F.lpad(F.col(part).cast("string"), 8, "0"))


def batch_of(supplier: str) -> Column:
    return F.concat(F.lit("batch_s"), F.lpad(F.col(supplier).cast("string"), 4, "0"))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    return li.select(title_of("l_partkey").alias("lccn"), batch_of("l_suppkey").alias("batch")).distinct()


def wanted(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").where(F.col("p_size") <= WANTED_MAX_SIZE)
    return p.select(title_of("p_partkey").alias("lccn"))


def urls(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    url = F.concat(F.lit(URL_BASE), batch_of("s_suppkey"), F.lit(".tar.bz2"))
    return s.select(url.alias("url")).select(B.batch_name(F.col("url")).alias("batch"), "url")


SQL_FIX = f"""edges AS (SELECT DISTINCT 'sn' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS lccn,
                                'batch_s' || lpad(CAST(l_suppkey AS VARCHAR), 4, '0') AS batch FROM lineitem),
wanted AS (SELECT 'sn' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS lccn FROM part WHERE p_size <= {WANTED_MAX_SIZE}),
urls AS (SELECT 'batch_s' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS batch,
                '{URL_BASE}batch_s' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') || '.tar.bz2' AS url
         FROM supplier WHERE s_acctbal > 0),
needed AS (SELECT DISTINCT batch FROM edges SEMI JOIN wanted ON edges.lccn = wanted.lccn)"""


def _degree_sql(key: str, value: str) -> str:
    return f"""WITH {SQL_FIX}
SELECT {key}, count(DISTINCT {value}) AS n, min({value}) AS first, max({value}) AS last FROM edges GROUP BY {key}"""


@register("lccn_batches", _degree_sql("lccn", "batch"))
def q_lccn_batches(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-8: what each title's set of batches holds; the sets themselves are the
    edge table (``batch_edges``)."""
    return B.degrees(edges(spark, sf), "lccn", "batch")


@register("batch_lccns", _degree_sql("batch", "lccn"))
def q_batch_lccns(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-9: the same relation read from the batches."""
    return B.degrees(edges(spark, sf), "batch", "lccn")


def batch_listing(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-14's landed shape: one page per order of the listing with its batches
    and their titles, nested."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    named = li.select("l_orderkey", batch_of("l_suppkey").alias("name"), title_of("l_partkey").alias("lccn"))
    per = named.groupBy("l_orderkey", "name").agg(F.collect_set("lccn").alias("lccns"))
    return per.groupBy("l_orderkey").agg(F.collect_list(F.struct("name", "lccns")).alias("batches"))


@register("batch_edges", f"WITH {SQL_FIX} SELECT lccn, batch FROM edges")
def q_batch_edges(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-14: listing pages (an order's lines: a few rows each) to edges."""
    return B.edges_from_listing(batch_listing(spark, sf))


@register("listed_titles", f"WITH {SQL_FIX} SELECT DISTINCT lccn FROM wanted")
def q_listed_titles(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-15: title listing pages, one per brand, with their items' ids."""
    p = table(spark, sf, "part").where(F.col("p_size") <= WANTED_MAX_SIZE)
    item = F.struct(F.concat(F.lit("/lccn/"), title_of("p_partkey"), F.lit("/")).alias("id"))
    return B.titles_from_listing(p.select(F.array(item, F.struct(F.lit("/about/").alias("id"))).alias("items")))


@register("listed_ocr", f"""WITH {SQL_FIX}
SELECT batch, url FROM urls""")
def q_listed_ocr(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-16: OCR listing pages to batch names and URLs."""
    s = table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    file = F.concat(batch_of("s_suppkey"), F.lit(".tar.bz2"))
    return B.ocr_batches(s.select(F.array(F.struct(file.alias("name"), F.concat(F.lit(URL_BASE), file).alias("url")))
                                  .alias("ocr")))


@register("batch_coverage", f"""WITH {SQL_FIX}
SELECT (SELECT count(DISTINCT lccn) FROM wanted) AS titles_wanted,
       (SELECT count(DISTINCT lccn) FROM edges SEMI JOIN wanted ON edges.lccn = wanted.lccn) AS titles_available,
       (SELECT count(*) FROM needed) AS batches_needed,
       (SELECT count(*) FROM needed SEMI JOIN urls ON needed.batch = urls.batch) AS batches_found,
       (SELECT count(*) FROM needed ANTI JOIN urls ON needed.batch = urls.batch) AS batches_not_found""")
def q_batch_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return B.coverage(wanted(spark, sf), edges(spark, sf), urls(spark, sf))


@register("batch_downloads", f"""WITH {SQL_FIX}
SELECT needed.batch, urls.url FROM needed JOIN urls ON needed.batch = urls.batch""")
def q_batch_downloads(spark: SparkSession, sf: str) -> DataFrame:
    need = B.needed_batches(wanted(spark, sf), edges(spark, sf))
    found, _ = B.batch_downloads(need, urls(spark, sf))
    return found.select("batch", "url")


@register("missing_batches", f"""WITH {SQL_FIX}
SELECT batch FROM needed ANTI JOIN urls ON needed.batch = urls.batch""")
def q_missing_batches(spark: SparkSession, sf: str) -> DataFrame:
    need = B.needed_batches(wanted(spark, sf), edges(spark, sf))
    _, missing = B.batch_downloads(need, urls(spark, sf))
    return missing


@register("first_batches", f"""WITH {SQL_FIX}
SELECT batch FROM needed ORDER BY batch LIMIT {FIRST_N}""")
def q_first_batches(spark: SparkSession, sf: str) -> DataFrame:
    return B.first_batches(B.needed_batches(wanted(spark, sf), edges(spark, sf)), FIRST_N)


@register("multimap_inversion", f"""WITH {SQL_FIX},
size AS (SELECT batch, count(*) AS n_lccns FROM edges GROUP BY batch)
SELECT batch, lccn, n_lccns FROM edges JOIN size USING (batch)""")
def q_multimap_inversion(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-9: the title -> batches multimap inverted to batch -> titles, as rows
    with the size of each batch's set; no set is gathered into one row."""
    e = edges(spark, sf)
    return e.join(B.degrees(e, "batch", "lccn").select("batch", F.col("n").alias("n_lccns")), "batch").select(
        "batch", "lccn", "n_lccns")
