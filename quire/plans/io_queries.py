"""Round trips: results written by the sinks, read back by the sources, and the
job configuration at work. Everything goes to a fresh place under the session's
shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CorpusConfig, DatasetDefinition, NewspaperSelection
from ..functions import keys
from ..functions import text as T
from ..operators import filters, tiles, training, vocab
from ..operators import layout as L
from ..sources import files, keyed_table, sinks
from ..sources.tables import table
from ..streaming import vocabulary_stream
from ..streaming.cleaning_stream import read_documents_stream, scratch_path
from .corpus_queries import MIN_FREQUENCY, SQL_TOKENS, STOPWORDS
from .layout_queries import SQL_COORDS, SQL_LABELLED, TILE_SIZE, _sql_tiles, coordinates, labelled
from .metadata_queries import _P, EXCLUDED_HOST, SQL_ORDER_KEYS, SQL_RECORDS, YEARS, order_keys, records, search_results
from .registry import register
from .sqlfrag import sql_str
from .sqlfrag import tokens as sql_tokens
from .vector_queries import SQL_CORRECTIONS, SQL_TRAINED, TRAIN_OPTIONS, _corrections, _tokens

RESULTS_PER_PAGE = 20


def land_search_pages(spark: SparkSession, results: DataFrame, path: str) -> None:
    """Search result pages as landed: one JSON object a file, with its results."""
    page = F.struct("id", "access_restricted", "online_format", "language", F.col("subject"), "date")
    (results.groupBy((F.col("page_id") / RESULTS_PER_PAGE).cast("long").alias("p"))  # 20 rows a group
     .agg(F.collect_list(page).alias("results")).select("results")
     .write.option("maxRecordsPerFile", 1).json(path))


def dated_results(spark: SparkSession, sf: str) -> DataFrame:
    r = search_results(spark, sf)
    lang = F.col("language")[0]
    # every third date is no date; the language is the subject
    date = F.when(F.col("page_id") % 3 == 0, F.lit("n.d.")).otherwise(
        F.concat((1860 + F.col("page_id") % 30).cast("string"), F.lit("-01-01")))
    return r.withColumns({"subject": F.array(lang), "date": date})


SQL_RESULTS = f"""results AS (
    SELECT page_id, url AS id, regexp_extract(url, '/([a-z][a-z])/', 1) AS code,
           CASE WHEN page_id % 3 = 0 THEN 'n.d.' ELSE (1860 + page_id % 30) || '-01-01' END AS date,
           starts_with(url, 'https://') AND regexp_extract(url, '/([a-z][a-z])/', 1) = 'en' AS usable
    FROM pages)"""


@register("landed_search_results", f"WITH {SQL_RESULTS} SELECT id, date, count(*) AS n FROM results GROUP BY ALL")
def q_landed_search_results(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-7: landed result pages, one row per result (counted, as urls repeat)."""
    path = scratch_path(spark, "search")
    land_search_pages(spark, dated_results(spark, sf), path)
    return files.read_search_results(spark, path).groupBy("id", "date").agg(F.count(F.lit(1)).alias("n"))


@register("dataset_parts", f"""WITH {SQL_RESULTS},
part AS (SELECT DISTINCT id FROM results WHERE usable AND (page_id % 2 = 0
         OR (page_id % 3 <> 0 AND 1860 + page_id % 30 BETWEEN 1863 AND 1877)))
SELECT id FROM part UNION SELECT 'item-1'""")
def q_dataset_parts(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9: a data set of one collection, one date-filtered collection and an
    item, out of their landed pages."""
    root, r = scratch_path(spark, "landing"), dated_results(spark, sf)
    land_search_pages(spark, r.where("page_id % 2 = 0"), f"{root}/even")
    land_search_pages(spark, r.where("page_id % 2 = 1"), f"{root}/odd")
    found = files.read_dataset(spark, root, DatasetDefinition(
        collections=("even",), date_filtered_collections=("odd",), items=("item-1",)))
    return found.select("id")


@register("subject_log", f"""WITH {SQL_RESULTS}
SELECT CASE code WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' WHEN 'es' THEN 'spanish' END
       AS subject FROM results WHERE usable AND NOT contains(coalesce(regexp_extract(id, '^[a-z]+://([^/:?#]+)', 1), ''),
       {sql_str(EXCLUDED_HOST)})""")
def q_subject_log(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-9: the subjects of the kept results."""
    kept = filters.usable_results(dated_results(spark, sf), excluded_host=EXCLUDED_HOST)
    return sinks.subject_log(kept)


@register("newspaper_selection", f"""WITH {SQL_ORDER_KEYS}
SELECT key AS doc_id FROM okeys WHERE regexp_matches(key, {_P})
  AND CAST(regexp_extract(key, '([0-9]{{4}})/[0-9]{{2}}/[0-9]{{2}}', 1) AS INTEGER) BETWEEN {YEARS[0]} AND {YEARS[1]}""")
def q_newspaper_selection(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9's newspapers: pages of the year window."""
    pages = order_keys(spark, sf).where(keys.is_page("key")).select(F.col("key").alias("doc_id"))
    return files.select_newspaper_pages(pages, NewspaperSelection(first_year=YEARS[0], last_year=YEARS[1]))


@register("path_filter", f"WITH {SQL_ORDER_KEYS} SELECT o_orderkey, key FROM okeys WHERE regexp_matches(key, '/1996/')")
def q_path_filter(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-6 / FLT-7: rows by a pattern on their path."""
    return filters.path_filter(order_keys(spark, sf), "/1996/", path="key").select("o_orderkey", "key")


@register("valid_utf8", "SELECT doc_id, text FROM documents WHERE doc_id % 10 <> 0")
def q_valid_utf8(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-12: texts as bytes, every tenth broken by a stray byte."""
    d = table(spark, sf, "documents")
    raw = F.col("text").cast("binary")
    broken = F.when(F.col("doc_id") % 10 == 0, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    return filters.valid_utf8(d.select("doc_id", broken.alias("content"))).select("doc_id", "text")


@register("identifier_list", "SELECT 'id ' || doc_id AS identifier, doc_id % 2 = 0 AS landed FROM documents")
def q_identifier_list(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4 / SRC-5: an identifier CSV with blank and padded lines, and the
    identifiers of texts already landed."""
    path = scratch_path(spark, "ids")
    d = table(spark, sf, "documents").select(F.concat(F.lit("id "), F.col("doc_id").cast("string")).alias("doc_id"), (
        F.col("doc_id") % 2 == 0).alias("even"))
    lines = d.select(F.explode(F.array(F.concat(F.lit("  "), F.col("doc_id"), F.lit(" ")), F.lit(" "))).alias("identifier"))
    lines.write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    landed = files.identifiers_from_texts(d.where("even")).withColumn("landed", F.lit(True))
    return (files.read_identifiers(spark, path).join(landed, "identifier", "left")
            .select("identifier", F.coalesce("landed", F.lit(False)).alias("landed")))


@register("dictionary_file", f"SELECT DISTINCT unnest({sql_tokens('text')}) AS word FROM benchmark")
def q_dictionary_file(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-12: a word list file with repeats."""
    path = scratch_path(spark, "words")
    table(spark, sf, "benchmark").select(F.explode(T.tokenize("text")).alias("word")).write.text(path)
    return files.read_dictionary(spark, path)


@register("metadata_json", SQL_RECORDS + " SELECT identifier, title, date, url FROM rec")
def q_metadata_json(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: records as ``{identifier: record}`` lines, parsed again."""
    path = scratch_path(spark, "metadata")
    sinks.write_metadata_json(records(spark, sf)[0], path)
    parsed = spark.read.text(path).select(F.explode(F.from_json("value", files.METADATA_FILE)).alias("identifier", "r"))
    return parsed.select("identifier", "r.title", "r.date", "r.url")


@register("coordinates_csv", f"WITH {SQL_COORDS} SELECT doc_id, round(x, 6) AS x, round(y, 6) AS y FROM coords")
def q_coordinates_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4 / SNK-5: coordinates with their key, through CSV."""
    path = scratch_path(spark, "coordinates")
    sinks.write_coordinates(coordinates(spark, sf), path)
    back = spark.read.csv(path, header=True, schema="doc_id LONG, x DOUBLE, y DOUBLE")
    return back.select("doc_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@register("unkeyed_coordinates", f"""WITH {SQL_COORDS}
SELECT round(x, 6) AS x, round(y, 6) AS y FROM coords""")
def q_unkeyed_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-10: a coordinates CSV without keys, header skipped."""
    path = scratch_path(spark, "xy")
    coordinates(spark, sf).select("x", "y").write.option("header", True).csv(path)
    return files.read_coordinates(spark, path).select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@register("labelled_csv", f"""WITH lab AS ({SQL_LABELLED})
SELECT doc_id, x, y, collections, "that" AS score FROM lab""")
def q_labelled_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: the labelled table as CSV, lists as JSON text."""
    path = scratch_path(spark, "labelled")
    sinks.write_labelled_csv(labelled(spark, sf), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("x").cast("double").alias("x"),
                       F.col("y").cast("double").alias("y"), "collections", F.col("that").cast("int").alias("score"))


@register("tiles_written", _sql_tiles())
def q_tiles_written(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-10: tiles as partitions, read back."""
    path = scratch_path(spark, "tiles")
    pts = labelled(spark, sf).select("doc_id", "x", "y", "date")
    sinks.write_tiles(tiles.quadtree_tiles(pts, L.shuffle_key("doc_id"), tile_size=TILE_SIZE), path)
    return spark.read.parquet(path).select("doc_id", *[F.col(c).cast("int").alias(c) for c in ("z", "tx", "ty", "page")])


@register("new_rows_only", "SELECT doc_id, lang FROM documents")
def q_new_rows_only(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-11: a first run writes a part, a rerun adds what is new."""
    path, d = scratch_path(spark, "new-only"), table(spark, sf, "documents").select("doc_id", "lang")
    for part in (d.where("doc_id % 3 = 0"), d, d):
        sinks.write_new_only(part, path, "doc_id")
    return spark.read.schema(d.schema).parquet(path)


@register("growing_vocabulary", f"""WITH {SQL_TOKENS}, w AS (SELECT doc_id, unnest(t) AS word FROM toks)
SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df FROM w GROUP BY word""")
def q_growing_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13 / AGG-1: documents that land in three runs (drafts of a third of them,
    all of them, the drafts again), summed up in between."""
    root = scratch_path(spark, "growing")
    docs = table(spark, sf, "documents").select("doc_id", F.lit(2).cast("long").alias("landed"), "text")
    drafts = docs.where("doc_id % 3 = 0").select(
        "doc_id", F.lit(1).cast("long").alias("landed"), F.concat("text", F.lit(" draft draft words")).alias("text"))
    for i, part in enumerate((drafts, docs, drafts)):
        part.write.mode("append").parquet(f"{root}/landed")
        stream = read_documents_stream(spark, f"{root}/landed", docs.schema)
        vocabulary_stream.update_vocabulary(stream, f"{root}/vocabulary", f"{root}/checkpoint")
        if i == 1:
            vocabulary_stream.compact(spark, f"{root}/vocabulary")
    return vocabulary_stream.read_vocabulary(spark, f"{root}/vocabulary")


# suppliers as landed texts: two of three are pages (title by nation, year by key), the
# others items
FIRST_YEAR = 1860
SQL_TREE = f"""doc AS (SELECT s_suppkey % 3 <> 0 AS page, s_name AS text, {FIRST_YEAR} + s_suppkey % 30 AS year,
    s_nationkey AS nation, CASE WHEN s_suppkey % 3 = 0 THEN 'mss' || s_suppkey ELSE
    'sn' || s_nationkey || '/' || ({FIRST_YEAR} + s_suppkey % 30) || '/01/02/ed-1/seq-' || s_suppkey END AS doc_id
    FROM supplier)"""


def _landed_tree(spark: SparkSession, sf: str) -> tuple[str, str]:
    s, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    page = F.concat(F.lit("b1/data/sn"), "s_nationkey", F.lit("/"), F.lit(FIRST_YEAR) + key % 30,
                    F.lit("/01/02/ed-1/seq-"), key, F.lit("/ocr.txt"))
    root = scratch_path(spark, "tree")
    texts = s.select((key % 3 != 0).alias("page"), page.alias("path"), F.concat(F.lit("mss"), key).alias("name"),
                     F.col("s_name").alias("text"))
    sinks.write_text_files(texts.where("page"), f"{root}/pages")
    sinks.write_text_files(texts.where("page").withColumn("path", F.replace("path", F.lit(".txt"), F.lit(".xml"))),
                           f"{root}/pages")
    sinks.write_text_files(texts.where("NOT page"), f"{root}/results", "name")
    return f"{root}/pages", f"{root}/results"


def _page_key():
    """Page keys from the title on: a tree may hold them below other folders."""
    return F.when(F.col("kind") == "page", keys.page_path("doc_id")).otherwise(F.col("doc_id")).alias("doc_id")


@register("landed_corpus", f"WITH {SQL_TREE} SELECT doc_id, CASE WHEN page THEN 'page' ELSE 'item' END AS kind, text FROM doc")
def q_landed_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1, SRC-1..3, FLT-9, SET-1: texts written as files, read as one corpus
    (the pages' XML twins are left out)."""
    return files.read_corpus(spark, *_landed_tree(spark, sf)).select(_page_key(), "kind", "text")


@register("landed_pages_selected", f"""WITH {SQL_TREE}
SELECT doc_id, text FROM doc WHERE page AND year BETWEEN 1865 AND 1877 AND nation IN (3, 7, 11)
UNION ALL SELECT doc_id, text FROM doc WHERE page AND year = 1880""")
def q_landed_pages_selected(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1, FLT-7, FLT-8: pages chosen by title and years, and by a folder pattern;
    only their files are opened."""
    root, _ = _landed_tree(spark, sf)
    chosen = files.read_pages(spark, root, lccns=("sn3", "sn7", "sn11"), years=(1865, 1877))
    return chosen.unionByName(files.read_pages(spark, root, "/1880/")).select(_page_key(), "text")


@register("interrupted_runs", """
SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 2 = 0 THEN lang ELSE upper(lang) END AS lang FROM documents""")
def q_interrupted_runs(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-11 / JN-7: three overlapping runs; the second stops before it replaces a
    bucket, the third finishes it, adds what is new and is repeated."""
    path, d = scratch_path(spark, "keyed"), table(spark, sf, "documents").select("doc_id", "lang")
    keyed_table.add_new(d.where("doc_id % 3 = 0"), path, "doc_id")
    keyed_table.prepare(d.where("doc_id % 2 = 0"), path, "doc_id")
    for _ in range(2):
        keyed_table.add_new(d.withColumn("lang", F.upper("lang")), path, "doc_id")
    return keyed_table.read_keyed(spark, path)


@register("reject_log", SQL_RECORDS + " SELECT doc_key, 'no item record' AS reason FROM asked ANTI JOIN items USING (identifier) "
            "WHERE (page OR CAST(substr(doc_key, 3) AS INTEGER) % 11 <> 0)")
def q_reject_log(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8: the reject log of a run and its rerun."""
    path, rejects = scratch_path(spark, "rejects"), records(spark, sf)[1]
    sinks.write_rejects(rejects, path)
    sinks.write_rejects(rejects, path)
    return spark.read.schema(rejects.schema).parquet(path)


@register("saved_vocabulary", f"""WITH {SQL_TOKENS}, w AS (SELECT doc_id, unnest(t) AS word FROM toks)
SELECT word, count(*) AS tf, count(DISTINCT doc_id) AS df FROM w GROUP BY word HAVING count(*) > {MIN_FREQUENCY}""")
def q_saved_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7 / AGG-13: frequencies saved, and read as the training vocabulary."""
    path = scratch_path(spark, "vocabulary")
    sinks.write_vocabulary(vocab.term_frequency(table(spark, sf, "documents")), path)
    return vocab.vocabulary(spark, saved_path=path, min_frequency=MIN_FREQUENCY)


@register("saved_corrections", SQL_CORRECTIONS + " SELECT nonword, good_word FROM corr")
def q_saved_corrections(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-13: corrections kept under their model's id."""
    root = scratch_path(spark, "corrections")
    sinks.write_corrections(_corrections(spark, sf), root, "model-1")
    return files.read_corrections(spark, root, "model-1").select("nonword", "good_word")


@register("saved_model", SQL_TRAINED + " SELECT word, list_sum(v)::BIGINT AS total FROM vec")
def q_saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6 / SRC-11: a trained model's vectors saved as a table and loaded."""
    path = f"{scratch_path(spark, 'models')}/{training.model_id('corpus')}"
    toks = _tokens(spark, sf)
    training.save_tables(path, training.train_distributed(toks, TRAIN_OPTIONS))
    return training.load_word_vectors(spark, path).select(
        "word", F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


# -- configuration -------------------------------------------------------------

_STOP = ", ".join(sql_str(w) for w in STOPWORDS)


@register("configured_tokens", rf"""
SELECT doc_id, len(list_filter({sql_tokens('text')}, lambda w: NOT list_contains([{_STOP}], w)))::INTEGER AS plain,
       len({sql_tokens("regexp_replace(text, '[0-9]+', ' ', 'g')")})::INTEGER AS filtered,
       len(string_split(text, chr(10)))::INTEGER AS lines
FROM documents""")
def q_configured_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-1, UDF-2, UDF-5: a stopword list applied after tokenising, an own
    stopword filter (numbers go) and an own tokeniser (lines)."""
    plain = CorpusConfig(stopwords=tuple(STOPWORDS), stopwords_after_tokenize=True)
    numbers = CorpusConfig(stopword_filter=lambda c: F.regexp_replace(c, "[0-9]+", " "))
    by_line = CorpusConfig(stopwords=None, tokenizer=T.lines)
    return table(spark, sf, "documents").select(
        "doc_id", F.size(plain.tokens("text")).alias("plain"), F.size(numbers.tokens("text")).alias("filtered"),
        F.size(by_line.tokens("text")).alias("lines"))


@register("configured_model", f"""WITH {SQL_TOKENS}
SELECT word, 8 AS dims FROM (SELECT unnest(t) AS word FROM toks) GROUP BY word HAVING count(*) > 60""")
def q_configured_model(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-3, UDF-4: the configured vocabulary threshold and model options."""
    cfg = CorpusConfig(min_frequency=60, model_options={"vectorSize": 16}, training_options={"vectorSize": 8})
    toks = _tokens(spark, sf)
    model = training.train_distributed(toks, cfg.model(), vocabulary=cfg.training_vocabulary(toks))
    return model.select("word", F.size("vector").alias("dims"))
