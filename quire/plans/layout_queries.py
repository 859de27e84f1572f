"""Layout and output-assembly queries (VEC-7, VIZ-1, VIZ-2, JN-5, JN-16).

Fixture mapping: document ``doc_id`` has the ``embeddings`` row with the
same ``vec_id`` as its document vector; metadata exists for labelled
documents (see ``fixtures``) and is extended with keyword scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metadata as M
from ..operators import corrections, graph_layout, layout, quality, scoring, tiles
from ..operators.vocab import with_row_index
from ..session import stage
from ..sources.tables import table
from .fixtures import SQL_METADATA, corpus_metadata
from .registry import register
from .sqlfrag import sql_str
from .sqlfrag import tokens as sql_tokens
from .vector_queries import BASE_WORDS, SQL_SCORES, word_vectors

DIM = 64
SEED = 7


def coordinates(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return layout.random_projection(e, DIM, SEED)


def _sql_axis(values) -> str:
    return "[" + ", ".join(repr(float(x)) for x in values) + "]::DOUBLE[]"


_AX, _AY = layout.projection_axes(DIM, SEED)
SQL_COORDS = f"""coords AS (
    SELECT vec_id AS doc_id,
           list_inner_product(embedding::DOUBLE[], {_sql_axis(_AX)}) / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS x,
           list_inner_product(embedding::DOUBLE[], {_sql_axis(_AY)}) / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS y
    FROM embeddings)"""


@register("layout_projection", f"WITH {SQL_COORDS} SELECT doc_id, round(x, 6) AS x, round(y, 6) AS y FROM coords")
def q_layout_projection(spark: SparkSession, sf: str) -> DataFrame:
    return coordinates(spark, sf).select("doc_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@register("layout_pca")
def q_layout_pca(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    return layout.pca_projection(e)


MARKS = 12    # landmarks of the checked distances
HOPS = 24     # rounds of the SQL; more than these graphs need


def _sql_landmark_distances() -> str:
    cos = "list_inner_product(q.v, c.v) / sqrt(list_inner_product(q.v, q.v)) / sqrt(list_inner_product(c.v, c.v))"
    return f"""WITH RECURSIVE node AS (
    SELECT min(vec_id) AS node, v FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) GROUP BY v),
near AS (SELECT src, dst, CAST(round({graph_layout.UNIT} * sqrt(greatest(0, 2 - 2 * sim)), 0) AS BIGINT) AS length
    FROM (SELECT q.node AS src, c.node AS dst, {cos} AS sim FROM node q JOIN node c ON q.node <> c.node)
    QUALIFY row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) <= {graph_layout.NEIGHBOURS}),
edge AS (SELECT src, dst, min(length) AS length FROM (
    SELECT src, dst, length FROM near UNION ALL SELECT dst, src, length FROM near UNION ALL SELECT node, node, 0 FROM node)
    GROUP BY ALL),
mark AS (SELECT node FROM node ORDER BY {_sql_shuffle('node')} LIMIT {MARKS}),
path(hop, landmark, node, distance) AS (
    SELECT 0, node, node, CAST(0 AS BIGINT) FROM mark
    UNION ALL
    SELECT hop + 1, landmark, edge.dst, CAST(min(distance + length) AS BIGINT) FROM path JOIN edge ON edge.src = path.node
    WHERE hop < {HOPS} GROUP BY hop, landmark, edge.dst)
SELECT landmark, node, distance FROM path WHERE hop = {HOPS}"""


def _doc_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))


def q_landmark_distances(spark: SparkSession, sf: str) -> DataFrame:
    """VEC-7: shortest paths from the landmarks over the nearest-neighbour graph."""
    nodes = stage(graph_layout.distinct_vectors(_doc_vectors(spark, sf)), "layout-nodes")
    marks = graph_layout.choose_landmarks(nodes, MARKS)
    edges = stage(graph_layout.neighbor_graph(nodes), "layout-edges")
    found = graph_layout.landmark_distances(edges, marks)
    each = F.explode(F.array(*[F.struct(F.lit(m).cast(found.schema["node"].dataType).alias("landmark"), F.col(f"d{i}").alias("distance"))
                               for i, m in enumerate(marks)])).alias("at")
    return found.select("node", each).where("at.distance IS NOT NULL").select("at.landmark", "node", "at.distance")


@register("layout_landmarks")
def q_layout_landmarks(spark: SparkSession, sf: str) -> DataFrame:
    """VEC-7: places by triangulation from landmark distances."""
    return graph_layout.landmark_layout(_doc_vectors(spark, sf))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    meta = corpus_metadata(spark, sf)
    meta = meta.select("doc_id", "title", "locations", "collections",
                       M.states_in(F.col("locations")).alias("states"),
                       F.create_map().cast("map<string,int>").alias(M.SCORE_NAMESPACE))
    docs = table(spark, sf, "documents").select("doc_id", "text").join(meta.select("doc_id"), "doc_id", "left_semi")
    scores = scoring.keyword_scores(docs, word_vectors(spark, sf), BASE_WORDS)
    meta = scoring.upsert_scores(meta, scores)
    out = layout.labelled_table(coordinates(spark, sf), meta, BASE_WORDS)
    return out.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


_SCORE_COLS = ",\n       ".join(
    f"max(sc.score) FILTER (WHERE sc.word = {sql_str(w)}) AS {_q(w)}" for w in BASE_WORDS)
_META_COLS = []
for _name in M.METADATA_ORDER:
    if _name in ("collections", "locations"):
        _META_COLS.append(f"CAST(to_json(meta.{_name}) AS VARCHAR) AS {_name}")
    elif _name == "states":
        _META_COLS.append("'[]' AS states")
    elif _name == "title":
        _META_COLS.append("meta.title AS title")
    else:
        _META_COLS.append(f"CAST(NULL AS VARCHAR) AS {_name}")

SQL_LABELLED = SQL_SCORES + f""",
{SQL_METADATA},
{SQL_COORDS}
SELECT coords.doc_id, round(coords.x, 6) AS x, round(coords.y, 6) AS y,
       {", ".join(_META_COLS)},
       {_SCORE_COLS}
FROM coords JOIN meta ON meta.doc_id = coords.doc_id LEFT JOIN sc ON sc.doc_id = coords.doc_id
GROUP BY ALL"""


@register("labelled_table", SQL_LABELLED)
def q_labelled_table(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf)


def _sql_shuffle(key: str) -> str:
    return f"md5('{layout.SHUFFLE_SEED}/' || {key}), {key}"


register("landmark_distances", _sql_landmark_distances())(q_landmark_distances)


@register("shuffled", f"""WITH lab AS ({SQL_LABELLED})
SELECT doc_id, x, y, title, row_number() OVER (ORDER BY {_sql_shuffle('doc_id')}) - 1 AS position FROM lab""")
def q_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """VIZ-2 / ORD-1 with each row's place in the shuffled order."""
    out = with_row_index(layout.shuffled(labelled(spark, sf)), "position")
    return out.select("doc_id", "x", "y", "title", "position")


@register("row_index", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders""")
def q_row_index(spark: SparkSession, sf: str) -> DataFrame:
    """A dense index in a given order, with other columns kept."""
    out = with_row_index(table(spark, sf, "orders"), "position", [F.col("o_totalprice"), F.col("o_orderkey")])
    return out.select("o_orderkey", "o_totalprice", "position")


@register("zip_positional", """
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS p FROM orders),
b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS p FROM customer)
SELECT o_orderkey, c_custkey FROM a JOIN b USING (p)""")
def q_zip_positional(spark: SparkSession, sf: str) -> DataFrame:
    """JN-4: two ordered sequences paired by position, cut to the shorter."""
    o = table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey")
    c = table(spark, sf, "customer").orderBy("c_acctbal", "c_custkey").select("c_custkey")
    return layout.zip_positional(o, c)


@register("zero_vector_layout", f"""
WITH {SQL_COORDS}
SELECT coords.doc_id, CASE WHEN l_toxic THEN NULL ELSE round(x, 6) END AS x,
       CASE WHEN l_toxic THEN NULL ELSE round(y, 6) END AS y
FROM coords JOIN (SELECT doc_id, max(toxic) = 1 AS l_toxic FROM labels GROUP BY doc_id) t ON t.doc_id = coords.doc_id""")
def q_zero_vector_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a zero vector (here: those labelled toxic) have no place."""
    flag = table(spark, sf, "labels").groupBy("doc_id").agg((F.max("toxic") == 1).alias("zero"))
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    v = e.join(flag, "doc_id").select("doc_id", F.when(F.col("zero"), F.transform("vector", lambda x: x * 0))
                                      .otherwise(F.col("vector")).alias("vector"))
    return layout.random_projection(v, DIM, SEED).select("doc_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


TILE_SIZE = 50   # small tiles so that the driver tables span several levels
SQL_LEVELS = 12  # more than these tables need; what is left would show as missing rows


def _sql_tiles() -> str:
    def index(c: str, z: int) -> str:
        return (f"least(greatest(CAST(floor((p.{c} - lo{c}) / CASE WHEN hi{c} = lo{c} THEN 1 ELSE hi{c} - lo{c} END"
                f" * {1 << z}) AS INTEGER), 0), {(1 << z) - 1})")

    parts = [f"""p0 AS (SELECT doc_id, x, y FROM lab),
bound AS (SELECT min(x) AS lox, max(x) AS hix, min(y) AS loy, max(y) AS hiy FROM p0)"""]
    for z in range(SQL_LEVELS):
        parts.append(f"""l{z} AS (SELECT p.doc_id, p.x, p.y, {index('x', z)} AS tx, {index('y', z)} AS ty FROM p{z} p, bound),
r{z} AS (SELECT *, row_number() OVER (PARTITION BY tx, ty ORDER BY {_sql_shuffle('doc_id')}) - 1 AS rank FROM l{z}),
p{z + 1} AS (SELECT doc_id, x, y FROM r{z} WHERE rank >= {TILE_SIZE})""")
    shown = " UNION ALL ".join(f"SELECT doc_id, {z}::INTEGER AS z, tx, ty, 0::INTEGER AS page FROM r{z} "
                               f"WHERE rank < {TILE_SIZE}" for z in range(SQL_LEVELS))
    return f"WITH lab AS ({SQL_LABELLED}), {', '.join(parts)} {shown}"


@register("tiles", _sql_tiles())
def q_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """VIZ-3: the level and tile at which each labelled point is first shown."""
    pts = labelled(spark, sf).select("doc_id", "x", "y")
    out = tiles.quadtree_tiles(pts, layout.shuffle_key("doc_id"), tile_size=TILE_SIZE)
    return out.select("doc_id", "z", "tx", "ty", "page")


# corpus_map: even documents are pages, odd ones items; licence lines play the
# archival note, a line that occurs often plays the attribution
MAP_FRONT = 1


def _sql_corpus_map() -> str:
    from .cleaning_queries import _SQL_STOP, MARKER, REPEATED_LINE
    from .corpus_queries import DICTIONARY_MIN_DF
    from .vector_queries import CORRECTION_THRESHOLD, SQL_WV, _sql_lev
    toks = sql_tokens("text")
    bases = ", ".join(sql_str(w) for w in BASE_WORDS)
    rest = f"array_to_string(string_split(text, chr(10))[{MAP_FRONT + 1}:], chr(10))"
    return f"""WITH {SQL_WV},
{SQL_METADATA},
{SQL_COORDS},
dict AS (SELECT w AS word FROM (SELECT DISTINCT doc_id, unnest(t) AS w FROM toks) GROUP BY w
         HAVING count(*) >= {DICTIONARY_MIN_DF}),
long AS (SELECT doc_id, unnest(list_distinct(list_filter(t, lambda x: length(x) > {quality.MIN_WORD_LENGTH}))) AS word
         FROM toks),
good AS (SELECT doc_id FROM long LEFT JOIN dict USING (word) GROUP BY doc_id
         HAVING count(dict.word)::DOUBLE / count(*) >= {quality.CUTOFF}),
front AS (SELECT doc_id, doc_id % 2 = 0 AS page, CASE WHEN doc_id % 2 = 0 OR regexp_matches(text, {sql_str(MARKER)})
                 THEN {rest} ELSE text END AS text FROM documents SEMI JOIN good USING (doc_id)),
cleaned AS (SELECT doc_id, page, CASE WHEN page THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)),
                   lambda l: NOT regexp_matches(l, {sql_str(REPEATED_LINE)})), chr(10)) END AS text FROM front),
ctok AS (SELECT doc_id, page, {toks} AS t FROM cleaned),
nonword AS (SELECT DISTINCT unnest(t) AS word FROM ctok EXCEPT SELECT word FROM dict),
near AS (SELECT q.word AS qid, c.word AS cid, list_cosine_similarity(q.v, c.v) AS sim
         FROM (SELECT * FROM wv SEMI JOIN nonword ON wv.word = nonword.word) q JOIN wv c ON q.word <> c.word
         QUALIFY row_number() OVER (PARTITION BY q.word ORDER BY sim DESC, c.word) <= {corrections.TOP_K}),
corr AS (SELECT qid AS word, cid AS out FROM near SEMI JOIN dict ON near.cid = dict.word
         WHERE sim > {CORRECTION_THRESHOLD}
           AND ({_sql_lev('qid', 'cid')} <= round_even({corrections.LEVENSHTEIN_FRACTION} * length(qid), 0)
                OR contains(cid, qid))
         QUALIFY row_number() OVER (PARTITION BY qid ORDER BY sim DESC, cid) = 1),
fix AS (SELECT word, word AS out FROM dict UNION ALL SELECT word, out FROM corr),
word AS (SELECT doc_id, unnest(t) AS word, unnest(range(len(t))) AS pos FROM ctok),
mended AS (SELECT doc_id, list(out ORDER BY pos) AS t FROM word JOIN fix USING (word) GROUP BY doc_id),
stop AS (SELECT doc_id, {_SQL_STOP} AS stop FROM meta),
final AS (SELECT mended.doc_id, CASE WHEN ctok.page AND stop IS NOT NULL
                 THEN list_filter(mended.t, lambda w: NOT list_contains(stop, w)) ELSE mended.t END AS t
          FROM mended JOIN ctok USING (doc_id) LEFT JOIN stop USING (doc_id)),
kept AS (SELECT doc_id, list_filter(t, lambda x: length(x) >= {scoring.MIN_WORD_LENGTH}) AS lt FROM final
         WHERE len(t) > 0),
base AS (SELECT word AS base, v AS bv FROM wv WHERE word IN ({bases})),
sims AS (SELECT wv.word, base.base, list_cosine_similarity(wv.v, base.bv) AS sim FROM wv, base),
total AS (SELECT doc_id, base, sum(sim) AS s FROM (SELECT doc_id, unnest(lt) AS word FROM kept) JOIN sims USING (word)
          GROUP BY ALL),
sc AS (SELECT kept.doc_id, base.base AS word, CAST(CASE WHEN len(lt) = 0 THEN 0
              ELSE round_even(100 * coalesce(s, 0) / len(lt), 0) END AS INTEGER) AS score
       FROM kept, base LEFT JOIN total ON total.doc_id = kept.doc_id AND total.base = base.base)
SELECT coords.doc_id, round(coords.x, 6) AS x, round(coords.y, 6) AS y, {", ".join(_META_COLS)}, {_SCORE_COLS}
FROM coords JOIN meta ON meta.doc_id = coords.doc_id SEMI JOIN kept ON kept.doc_id = coords.doc_id
     LEFT JOIN sc ON sc.doc_id = coords.doc_id
GROUP BY ALL"""


@register("corpus_map", _sql_corpus_map())
def q_corpus_map(spark: SparkSession, sf: str) -> DataFrame:
    """VIZ-4: every stage composed over the driver tables (quality filter with
    the df>=5 dictionary, cleaning by kind, nonword correction with the fixture
    vectors, per-document stopwords, keyword scores, layout, labelled and
    shuffled output). Only documents with metadata (labels) and a vector
    (embeddings) can be on the map."""
    from .cleaning_queries import MARKER, REPEATED_LINE
    from .corpus_queries import corpus_dictionary
    from .end_to_end import MapOptions, corpus_map
    from .vector_queries import CORRECTION_THRESHOLD
    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit("page")).otherwise(F.lit("item")).alias("kind"), "text")
    meta = corpus_metadata(spark, sf).select(
        "doc_id", "title", "locations", "collections", M.states_in(F.col("locations")).alias("states"),
        F.create_map().cast("map<string,int>").alias(M.SCORE_NAMESPACE))
    wv = word_vectors(spark, sf)
    dv = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    opts = MapOptions(keywords=BASE_WORDS, correction_threshold=CORRECTION_THRESHOLD, layout_seed=SEED,
                      frontmatter_lines=MAP_FRONT, archival_lines=MAP_FRONT, archival_marker=MARKER,
                      attribution=REPEATED_LINE)
    stages = corpus_map(docs, meta, corpus_dictionary(docs), opts, previous_vectors=wv,
                        word_vectors=wv, doc_vectors=dv)
    out = stages["labelled"]
    return out.withColumn("x", F.round("x", 6)).withColumn("y", F.round("y", 6))
