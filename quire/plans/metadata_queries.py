"""Key parsing, metadata projection, search-result and date filters.

Fixture mapping (SURVEY §7.3):
* page / item keys are built from ``orders``: finished orders become page
  keys ``sn<custkey>/<yyyy/mm/dd>/ed-1/seq-<priority digit>`` inside a
  ``data/…/ocr.txt`` path, the others item keys ``results/mss<orderkey>``;
* search results come from ``pages`` (id = url, language from the path);
* locations / subjects come from customer, nation and region names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions import metadata as M
from ..functions.text import tokenize
from ..operators import filters, metadata, patterns, stats
from ..sources.tables import table
from .registry import register
from .sqlfrag import sql_str
from .sqlfrag import tokens as sql_tokens

YEARS = (1996, 1998)
# region names play the role of the state list for the customer locations
REFERENCE_PLACES = ("Africa", "America", "Asia", "Europe", "Middle East")
EXCLUDED_HOST = "blog."
LANGUAGE_NAMES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def order_keys(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    page = F.concat(F.lit("data/sn"), F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("/"),
                    F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/ed-1/seq-"),
                    F.substring("o_orderpriority", 1, 1), F.lit("/ocr.txt"))
    item = F.concat(F.lit("results/mss"), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", page).otherwise(item).alias("key"))


SQL_ORDER_KEYS = """okeys AS (
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F'
                THEN 'data/sn' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || '/'
                     || strftime(o_orderdate, '%Y/%m/%d') || '/ed-1/seq-' || substr(o_orderpriority, 1, 1)
                     || '/ocr.txt'
                ELSE 'results/mss' || CAST(o_orderkey AS VARCHAR) END AS key
    FROM orders)"""

_P = sql_str(keys.PAGE_KEY_RE)
_D = sql_str(keys.DATE_RE)
SQL_PAGE_PATH = (f"replace(substr(key, strpos(key, regexp_extract(key, {_P}, 1))), "
                 f"'{keys.OCR_FILE}', '')")
SQL_PAGE_DATE = (f"regexp_extract(key, {_D}, 1) || '-' || regexp_extract(key, {_D}, 2) || '-' "
                 f"|| regexp_extract(key, {_D}, 3)")
SQL_PAGE_URL = (f"'{keys.PAGE_URL_BASE}' || regexp_replace({SQL_PAGE_PATH}, {_D}, '\\1-\\2-\\3', 'g')")


@register("key_parsing", f"""
WITH {SQL_ORDER_KEYS},
k AS (SELECT o_orderkey, key, regexp_matches(key, {_P}) AS is_page FROM okeys)
SELECT o_orderkey, key,
       CASE WHEN is_page THEN 'page' ELSE 'item' END AS kind,
       CASE WHEN is_page THEN trim(regexp_extract(key, {_P}, 1))
            ELSE list_filter(string_split(key, '/'), lambda s: s <> '')[-1] END AS identifier,
       list_filter(string_split(key, '/'), lambda s: s <> '')[-1] AS filename,
       CASE WHEN is_page THEN {SQL_PAGE_PATH} END AS path,
       CASE WHEN is_page THEN {SQL_PAGE_DATE} END AS date,
       CASE WHEN is_page THEN substr({SQL_PAGE_DATE}, 1, 4) END AS year,
       CASE WHEN is_page THEN {SQL_PAGE_URL} END AS url,
       CASE WHEN is_page THEN regexp_replace({SQL_PAGE_URL}, '/+$', '') || '/{keys.THUMBNAIL}' END AS image_url
FROM k""")
def q_key_parsing(spark: SparkSession, sf: str) -> DataFrame:
    k = order_keys(spark, sf)
    page = keys.is_page("key")
    date = keys.page_date("key")
    url = keys.page_url("key")
    return k.select(
        "o_orderkey", "key", keys.kind("key").alias("kind"),
        keys.identifier("key").alias("identifier"),
        keys.last_segment("key").alias("filename"),
        F.when(page, keys.page_path("key")).alias("path"),
        F.when(page, date).alias("date"),
        F.when(page, keys.year_of(date)).alias("year"),
        F.when(page, url).alias("url"),
        F.when(page, keys.thumbnail_url(url)).alias("image_url"))


@register("year_range", f"""
WITH {SQL_ORDER_KEYS},
m AS (SELECT o_orderkey, {SQL_PAGE_DATE} AS date FROM okeys WHERE regexp_matches(key, {_P}))
SELECT o_orderkey, date, substr(date, 1, 4) AS year FROM m
WHERE CAST(substr(date, 1, 4) AS INTEGER) BETWEEN {YEARS[0]} AND {YEARS[1]}""")
def q_year_range(spark: SparkSession, sf: str) -> DataFrame:
    pages = order_keys(spark, sf).where(keys.is_page("key"))
    recs = pages.select("o_orderkey", keys.page_date("key").alias("date"))
    recs = recs.withColumn("year", keys.year_of("date"))          # JN-17 backfill
    return filters.year_range(recs, F.col("year").cast("int"), *YEARS)


def customer_places(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    # nation and region are dimension tables of fixed size: broadcast
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
            .select("c_custkey", "c_mktsegment",
                    F.array(F.lower("n_name"), F.lower("r_name"), F.lower("r_name")).alias("location")))


SQL_PLACES = """places AS (
    SELECT c_custkey, c_mktsegment, [lower(n_name), lower(r_name), lower(r_name)] AS location
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@register("states_from_locations", f"""
WITH {SQL_PLACES},
l AS (SELECT c_custkey, list_distinct(location) AS locations FROM places)
SELECT c_custkey,
       array_to_string(list_sort(locations), '|') AS locations,
       array_to_string(list_sort(list_filter(list_distinct(list_transform(locations, lambda x: list_aggregate(
           list_transform(string_split(x, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' '))),
           lambda s: list_contains([{", ".join(sql_str(p) for p in REFERENCE_PLACES)}], s))), '|') AS states
FROM l""")
def q_states_from_locations(spark: SparkSession, sf: str) -> DataFrame:
    p = customer_places(spark, sf)
    locs = M.dedup_locations("location")
    return p.select(
        "c_custkey",
        F.array_join(F.sort_array(locs), "|").alias("locations"),
        F.array_join(F.sort_array(M.states_in(locs, REFERENCE_PLACES)), "|").alias("states"))


@register("subject_counts", f"""
WITH {SQL_PLACES},
s AS (SELECT unnest([location[1], location[2], lower(c_mktsegment)]) AS subject FROM places)
SELECT subject, count(*) AS count FROM s GROUP BY subject""")
def q_subject_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = customer_places(spark, sf).select(
        F.array(F.col("location")[0], F.col("location")[1], F.lower("c_mktsegment")).alias("subject"))
    return stats.value_counts(p, "subject", name="subject")


def search_results(spark: SparkSession, sf: str) -> DataFrame:
    pg = table(spark, sf, "pages").select("page_id", "url")
    code = F.regexp_extract("url", r"/([a-z][a-z])/", 1)
    lang = F.create_map(*[x for kv in LANGUAGE_NAMES.items() for x in map(F.lit, kv)])[code]
    return pg.select(
        "page_id", F.col("url").alias("id"),
        (~F.col("url").startswith("https://")).alias("access_restricted"),
        F.array(F.lit(filters.ONLINE_TEXT)).alias("online_format"),
        F.array(lang).alias("language"))


@register("usable_results", f"""
SELECT page_id, url AS id FROM pages
WHERE starts_with(url, 'https://')
  AND regexp_extract(url, '/([a-z][a-z])/', 1) = 'en'
  AND NOT contains(coalesce(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), ''), {sql_str(EXCLUDED_HOST)})""")
def q_usable_results(spark: SparkSession, sf: str) -> DataFrame:
    res = filters.usable_results(search_results(spark, sf), excluded_host=EXCLUDED_HOST)
    return res.select("page_id", "id")


# -- item records -------------------------------------------------------------
#
# Items are customers: ``partof`` lists their segment as a collection and their
# nation as a site (without a url for customers in debt), ``image_url`` two
# sizes, dates and ids from the key. Page keys are finished orders, whose lccn is
# their customer, so one item record serves many pages.

ITEM_URL = "https://example.org/item/"


def items(spark: SparkSession, sf: str) -> DataFrame:
    c = customer_places(spark, sf).join(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"),
                                        "c_custkey")
    ident = F.concat(F.lit("sn"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    entry = lambda title, url: F.struct(title.alias("title"), url.alias("url"))
    partof = F.array(
        entry(F.col("c_mktsegment"), F.concat(F.lit("https://example.org/collections/"), F.lower("c_mktsegment"))),
        entry(F.col("location")[0], F.when(F.col("c_acctbal") >= 0, F.lit("https://example.org/sites/"))))
    url = F.concat(F.lit(ITEM_URL), ident)
    item = F.struct(
        partof.alias("partof"), F.col("c_name").alias("title"),
        F.array(F.create_map(F.lit("name"), F.col("c_mktsegment"))).alias("subjects"),
        F.array("c_mktsegment").alias("subject_headings"), F.col("location").alias("location"),
        F.array("c_name").alias("description"),
        F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("18"), F.lpad((F.col("c_custkey") % 90 + 10).cast("string"),
                                                                          2, "0"))).alias("date"),
        url.alias("url"),
        F.when(F.col("c_custkey") % 5 != 0, F.array(F.concat(url, F.lit("/a.jpg")), F.concat(url, F.lit("/b.jpg"))))
        .alias("image_url"))
    # a customer in ten has no record
    return c.where(F.col("c_custkey") % 10 != 0).select(ident.alias("identifier"), item.alias("item"))


SQL_ITEMS = f"""{SQL_PLACES},
items AS (
    SELECT 'sn' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS identifier, c.c_custkey AS k, c.c_name AS title,
           CASE WHEN c.c_acctbal >= 0 THEN [places.c_mktsegment] END AS collections, list_distinct(location) AS locations,
           CASE WHEN c.c_custkey % 7 <> 0 THEN '18' || lpad(CAST(c.c_custkey % 90 + 10 AS VARCHAR), 2, '0') END AS date,
           '{ITEM_URL}sn' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS url, places.c_mktsegment AS segment
    FROM customer c JOIN places ON places.c_custkey = c.c_custkey WHERE c.c_custkey % 10 <> 0)"""


def wanted_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Page keys of finished orders and the item ids of all customers."""
    pages = order_keys(spark, sf).where(keys.is_page("key")).select(F.col("key").alias("identifier"))
    ids = table(spark, sf, "customer").select(
        F.concat(F.lit("sn"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("identifier"))
    return pages.unionByName(ids)


SQL_WANTED = f"""{SQL_ORDER_KEYS},
wanted AS (SELECT DISTINCT key AS doc_key, true AS page FROM okeys WHERE regexp_matches(key, {_P})
           UNION ALL SELECT 'sn' || lpad(CAST(c_custkey AS VARCHAR), 8, '0'), false FROM customer),
asked AS (SELECT doc_key, page, CASE WHEN page THEN trim(regexp_extract(doc_key, {_P}, 1)) ELSE doc_key END AS identifier
          FROM wanted)"""


def records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Keys divisible by eleven are already in the output (JN-7)."""
    existing = table(spark, sf, "customer").where(F.col("c_custkey") % 11 == 0).select(
        F.concat(F.lit("sn"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("identifier"))
    return metadata.fetch_metadata(wanted_keys(spark, sf), items(spark, sf), existing=existing)


SQL_PAGE = SQL_PAGE_PATH.replace("key", "doc_key")
SQL_PAGE_DAY = SQL_PAGE_DATE.replace("key", "doc_key")
SQL_PAGE_LINK = SQL_PAGE_URL.replace("key", "doc_key")
SQL_NEW = "(page OR CAST(substr(doc_key, 3) AS INTEGER) % 11 <> 0)"
SQL_RECORDS = f"""WITH {SQL_WANTED}, {SQL_ITEMS},
rec AS (SELECT doc_key, asked.identifier, page, k, collections, title, segment, locations,
               CASE WHEN page THEN {SQL_PAGE_DAY} ELSE date END AS date,
               CASE WHEN page THEN {SQL_PAGE_LINK} ELSE url END AS url,
               CASE WHEN page THEN regexp_replace({SQL_PAGE_LINK}, '/+$', '') || '/{keys.THUMBNAIL}'
                    WHEN k % 5 <> 0 THEN url || '/a.jpg' END AS image_url
        FROM asked JOIN items USING (identifier) WHERE {SQL_NEW})"""


@register("metadata_records", SQL_RECORDS + """
SELECT doc_key, identifier, array_to_string(collections, '|') AS collections, title,
       array_to_string(list_sort(locations), '|') AS locations, date, substr(date, 1, 4) AS year, url, image_url,
       segment AS subject, title AS description
FROM rec""")
def q_metadata_records(spark: SparkSession, sf: str) -> DataFrame:
    """FN-8, FN-11, ORD-5, JN-6, JN-7: the records of pages and items."""
    found, _ = records(spark, sf)
    return found.select(
        "doc_key", "identifier", F.array_join("collections", "|").alias("collections"), "title",
        F.array_join(F.sort_array("locations"), "|").alias("locations"), "date", "year", "url", "image_url",
        F.col("subjects")[0]["name"].alias("subject"), F.col("description")[0].alias("description"))


@register("metadata_rejects", f"""WITH {SQL_WANTED}, {SQL_ITEMS}
SELECT doc_key, 'no item record' AS reason FROM asked ANTI JOIN items USING (identifier) WHERE {SQL_NEW}""")
def q_metadata_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8: keys whose item is missing."""
    return records(spark, sf)[1]


@register("metadata_unwrapped", SQL_RECORDS + " SELECT doc_key, title, date FROM rec")
def q_metadata_unwrapped(spark: SparkSession, sf: str) -> DataFrame:
    """FN-23: the record taken out of its ``{identifier: record}`` wrapper."""
    found, _ = records(spark, sf)
    wrapped = found.select("doc_key", F.create_map("identifier", F.struct("title", "date")).alias("m"), "identifier")
    return wrapped.select("doc_key", M.unwrap("m", F.col("identifier")).alias("r")).select("doc_key", "r.*")


@register("documents_with_metadata", SQL_RECORDS + """
SELECT wanted.doc_key, title IS NOT NULL AS has_metadata, rec.title FROM wanted LEFT JOIN rec USING (doc_key)""")
def q_documents_with_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3: documents joined with their metadata, and those without."""
    found, _ = records(spark, sf)
    docs = wanted_keys(spark, sf).select(F.col("identifier").alias("doc_key")).distinct()
    joined, missing = metadata.documents_with_metadata(docs, found.select("doc_key", "title"), key="doc_key")
    return (joined.select("doc_key", F.lit(True).alias("has_metadata"), "title")
            .unionByName(missing.select("doc_key", F.lit(False).alias("has_metadata"),
                                        F.lit(None).cast("string").alias("title"))))


@register("year_backfill", SQL_RECORDS + """
SELECT doc_key, date, CASE WHEN page THEN substr(date, 1, 4) ELSE 'old' END AS year FROM rec""")
def q_year_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """JN-17: records that have a text (here: the pages) take their year from the
    date, the others keep theirs."""
    found, _ = records(spark, sf)
    texts = order_keys(spark, sf).where(keys.is_page("key")).select(F.col("key").alias("doc_key"))
    old = found.select("doc_key", "date", F.lit("old").alias("year"))
    return metadata.backfill_year(old, texts, key="doc_key")


@register("document_keys", f"""WITH {SQL_ORDER_KEYS}
SELECT o_orderkey, regexp_replace(replace(substr(key, length('data/') + 1), '{keys.OCR_FILE}', ''), '^/+|/+$', '', 'g')
       AS doc_key FROM okeys WHERE starts_with(key, 'data/')""")
def q_document_keys(spark: SparkSession, sf: str) -> DataFrame:
    """FN-13: file paths to document keys."""
    k = order_keys(spark, sf).where(F.col("key").startswith("data/"))
    return k.select("o_orderkey", keys.doc_key("key", "data/").alias("doc_key"))


@register("title_allow_list", """
SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'widget') OR contains(lower(p_name), 'large b')""")
def q_title_allow_list(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-21: rows whose title holds one of the allowed names."""
    return filters.title_allow_list(table(spark, sf, "part").select("p_partkey", "p_name"), ["Widget", "LARGE B"],
                                    title="p_name")


SQL_NAMES = f"""line AS (SELECT doc_id, lower(string_split(text, chr(10))[1]) AS t FROM documents),
name AS (SELECT DISTINCT w AS name FROM (SELECT unnest({sql_tokens('text')}) AS w FROM benchmark) WHERE length(w) > 2)"""
SQL_MATCHES = f"""WITH {SQL_NAMES},
hit AS (SELECT doc_id, name, t, unnest(range(1, length(t) - length(name) + 2)) AS p
        FROM line JOIN name ON contains(t, name))
SELECT doc_id, name, CAST(p AS INTEGER) AS place FROM hit WHERE substr(t, p, length(name)) = name"""


def _titles_and_names(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Titles are the documents' first lines, names the words of the benchmark."""
    titles = table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).getItem(0).alias("title"))
    words = table(spark, sf, "benchmark").select(F.explode(tokenize("text")).alias("name"))
    return titles, words.where(F.length("name") > 2)


@register("title_matches", SQL_MATCHES)
def q_title_matches(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-21: every place of every name in every title, by one automaton."""
    return patterns.title_matches(*_titles_and_names(spark, sf))


@register("title_matches_by_prefix", SQL_MATCHES)
def q_title_matches_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-21: the same by a join on prefixes, the way of name tables of any size."""
    return patterns.title_matches(*_titles_and_names(spark, sf), automaton_bytes=0)


@register("titles_with_names", f"""WITH {SQL_NAMES}
SELECT doc_id FROM line SEMI JOIN (SELECT name FROM name WHERE length(name) > 6) long ON contains(t, name)""")
def q_titles_with_names(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-21: the titles that hold one of the names (here: the long ones)."""
    titles, names = _titles_and_names(spark, sf)
    return patterns.titles_with_names(titles, names.where(F.length("name") > 6)).select("doc_id")


@register("found_texts", """
SELECT DISTINCT CAST(l.doc_id AS VARCHAR) AS identifier, e.vec_id IS NOT NULL AS found
FROM documents l LEFT JOIN embeddings e ON e.vec_id = l.doc_id""")
def q_found_texts(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-22: wanted identifiers (documents) split by whether their landed row
    (embeddings) was found."""
    wanted = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("identifier"))
    landed = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("doc_id"))
    found, rejects = filters.restrict_to_found(wanted, landed)
    return found.withColumn("found", F.lit(True)).unionByName(
        rejects.select("identifier").withColumn("found", F.lit(False)))
