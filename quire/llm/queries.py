"""The registered queries of the training-data operators. Each applies one
operator to its whole table and derives the contract's columns from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, hard_negatives, html_extract, license_scan, pack, periodic, quality_model, quality_rules,
    scaled_sketch, sharding, simhash, token_count,
)
from .common import held_out, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns of the conversations' transcripts. The model is
    counted on the conversations outside the held-out fold."""
    messages = chat.transcripts(read_table(spark, sf_dir, "conversations"))
    rows = chat.ordered(messages, role=F.when(~held_out(F.col("conv_id")), F.col("role")))
    found = chat.parse(rows, chat.fit(rows))
    return found.select("conv_id", "turn", "part", "role", "opens_turn", "n_lines", "rendered")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    found = decontaminate.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                               read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP2_WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2_SQL = rf"""
WITH item AS (SELECT item_id, {OP2_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t
        FROM item, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS r(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, coalesce({OP2_WORDS}, []) AS w FROM documents),
place AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS t
          FROM doc, (SELECT DISTINCT size FROM win), unnest(range(1, len(w) - size + 2)) AS r(i)),
hit AS (SELECT doc_id, size, i, item_id FROM place JOIN win USING (size, t)),
word AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, unnest(range(size)) AS r(k) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
          FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(word.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(word.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the rule ensemble fitted outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


OVER_LIMIT = 4096


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    found = token_count.count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the log-likelihood-ratio verdict of every document."""
    return quality_rules.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "llr_micro")


_Q = quality_rules
OP6_SQL = rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
             FROM documents),
word AS (SELECT doc_id, i, w[i] AS x, CAST(md5_number_lower(w[i]) % {_Q.PRIME} AS BIGINT) AS h
         FROM doc, unnest(range(1, len(w) + 1)) AS r(i)),
gram AS (SELECT doc_id, h % {_Q.BUCKETS} AS b FROM word
         UNION ALL
         SELECT doc_id, ((h * {_Q.PAIR_A} + next * {_Q.PAIR_B}) % {_Q.PRIME}) % {_Q.BUCKETS}
         FROM (SELECT doc_id, h, lead(h) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM word) WHERE next IS NOT NULL),
good AS (SELECT DISTINCT doc_id, CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8) AS BIGINT) % {_Q.FOLDS} = 0 AS fold
         FROM labels WHERE quality = 1),
cell AS (SELECT b, count(*) AS r, count(*) FILTER (WHERE NOT fold) AS t FROM gram LEFT JOIN good USING (doc_id) GROUP BY b),
total AS (SELECT sum(r) AS r, sum(t) AS t, {_Q.PRIOR_SHARE} * CAST(sum(t) AS DOUBLE) / {_Q.BUCKETS} AS prior FROM cell),
ratio AS (SELECT b, CASE WHEN total.t = 0 THEN 0 ELSE CAST(round_even({_Q.MICRO} * ln((cell.t + prior) /
                 (CAST(cell.r AS DOUBLE) * (CAST(total.t AS DOUBLE) / total.r) + prior)), 0) AS BIGINT) END AS v
          FROM cell, total),
llr AS (SELECT doc_id, CAST(sum(v) AS BIGINT) AS v FROM gram JOIN ratio USING (b) GROUP BY doc_id),
line AS (SELECT doc_id, CAST(count(*) - count(DISTINCT l) AS BIGINT) AS n
         FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM doc)
         WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times
        FROM (SELECT doc_id, i, x AS a, lead(x) OVER d AS b, lead(x, 2) OVER d AS c
              FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)) WHERE c IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM win, unnest(range(3)) AS r(k) WHERE times > 1 GROUP BY doc_id),
stat AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                coalesce(line.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(llr.v, 0) AS llr_micro
         FROM doc LEFT JOIN line USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN llr USING (doc_id)),
base AS (SELECT *, n_words < {_Q.MIN_WORDS} OR 100 * n_repeat_words > {_Q.MAX_REPEATED} * n_words AS base_failed FROM stat),
mean AS (SELECT CAST(floor(llr_micro / CAST({_Q.MICRO // _Q.MILLI} * (2 * n_words - 1) AS DOUBLE)) AS BIGINT) AS m
         FROM base JOIN good USING (doc_id) WHERE fold AND NOT base_failed),
placed AS (SELECT m, row_number() OVER (ORDER BY m) AS r, count(*) OVER () AS n FROM mean),
limits AS (SELECT CASE WHEN (SELECT t FROM total) > 0 THEN 2 * min(m) FILTER (WHERE 100 * r >= {_Q.LOW_PERCENT} * n) -
                  min(m) FILTER (WHERE 100 * r >= {_Q.MIDDLE_PERCENT} * n) END AS least FROM placed)
SELECT base.*, NOT base_failed AND (least IS NULL OR llr_micro >= {_Q.MICRO // _Q.MILLI} * least * (2 * n_words - 1)) AS kept
FROM base, limits
"""


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices found in every document."""
    found = license_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.coverage"), F.lit(0.0)).alias("coverage"),
        F.aggregate("matches", F.lit(0).cast("long"), lambda n, m: n + m["past"] - m["first"]).alias("matched_words"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    shards = [f"shard-{k:03d}" for k in range(sharding.SHARDS)]
    return sharding.place(read_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", shards)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of at most 2048 tokens."""
    pieces = pack.pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_length", "padded_length")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``, the input of ``op11_periodic_runs``: of a tenth of the
    documents, the words from a place on repeat the first few of them. A null
    doc_id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    marked = docs.select("doc_id", "text", (h % 10).alias("kind"), F.floor(h / 10).alias("g"))
    cut = marked.withColumn("w", F.when(F.col("kind") == 0, words)).withColumn("n", F.size("w"))
    at = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    p = F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1
    part = lambda c, start, size: F.slice(c, start.cast("int"), size.cast("int"))
    n, a = F.col("n"), F.col("a")
    block = F.array_repeat(part("w", a + 1, F.col("p")), F.ceil((n - a) / F.col("p")).cast("int"))
    edited = F.concat(part("w", F.lit(1), a), part(F.flatten(block), F.lit(1), n - a))
    return at.withColumn("p", p).select(
        "doc_id", F.when((F.col("kind") == 0) & (n > 0), F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, and the text without repeats."""
    found = periodic.find_runs(repeated_tails(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.short")
    return best.select("doc_id", "n_runs", (-F.col("best.back")).alias("start"), length.alias("length"),
                       period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, with a seventh of the labels moved."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


_H = hard_negatives
OP12_SQL = f"""
WITH vec AS (SELECT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({_H.SCALE} * x)) AS v
             FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
row AS (SELECT DISTINCT ON (id) * FROM vec ORDER BY id, label, v),
score AS (SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS s
          FROM row a JOIN row c ON a.id % 100 = 0 AND a.id <> c.id),
pos AS (SELECT anchor_id, id, s FROM score WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= {_H.POSITIVES})
SELECT anchor_id, pos.id AS positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, pos.id ORDER BY score.s DESC, score.id) AS INTEGER) AS rank,
       score.id AS negative_id, pos.s AS positive_score, score.s AS negative_score
FROM pos JOIN score USING (anchor_id)
WHERE NOT same AND {_H.LOW} * pos.s <= 100 * score.s AND 100 * score.s <= {_H.HIGH} * pos.s
QUALIFY rank <= {_H.NEGATIVES}
"""


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    return scaled_sketch.against_next(read_table(spark, sf_dir, "documents"))


_S = scaled_sketch
OP13_SUM = " + ".join(f"coalesce(lead({{0}}, {k}) OVER o, 0) * {w} % {_S.PRIME}" for k, w in enumerate(_S.PLACES))
OP13_SQL = rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
edit AS (SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next,
                coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id
         FROM doc WINDOW o AS (ORDER BY doc_id DESC)),
two AS (SELECT doc_id, 0 AS k, text FROM edit
        UNION ALL SELECT doc_id, 1, left(text, n - n // 2) || left(next, n // 2) FROM edit),
list AS (SELECT doc_id, k, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^ 	-
]+') AS w FROM two),
word AS (SELECT doc_id, k, i, len(w) AS n, CAST(md5_number_lower(w[i]) % {_S.PRIME} AS BIGINT) AS a,
                CAST(md5_number_upper(w[i]) % {_S.PRIME} AS BIGINT) AS b
         FROM list, unnest(range(1, len(w) + 1)) AS r(i)),
sums AS (SELECT doc_id, k, i, n, ({OP13_SUM.format("a")} + least(n, 5) * {_S.SIZE_WEIGHT}) % {_S.PRIME} AS one,
                ({OP13_SUM.format("b")} + least(n, 5) * {_S.SIZE_WEIGHT}) % {_S.PRIME} AS two
         FROM word WINDOW o AS (PARTITION BY doc_id, k ORDER BY i)),
hash AS (SELECT DISTINCT doc_id, k, one * {1 << _S.LOW_BITS} + two % {1 << _S.LOW_BITS} AS h
         FROM sums WHERE i <= greatest(n - 4, 1)),
kept AS (SELECT doc_id, k, h FROM hash
         QUALIFY h < {_S.FRACTION} OR row_number() OVER (PARTITION BY doc_id, k ORDER BY h) <= {_S.LEAST}),
made AS (SELECT doc_id, k, list(h ORDER BY h) AS hs, string_agg(printf('%012x', h), '' ORDER BY h) AS fp
         FROM kept GROUP BY doc_id, k),
sketch AS (SELECT doc_id, k, coalesce(hs, []) AS hs, coalesce(fp, '') AS fp,
                  CASE WHEN coalesce(len(hs), 0) < {_S.LEAST} THEN {_S.WHOLE} ELSE greatest({_S.FRACTION - 1}, list_max(hs)) END AS top
           FROM two LEFT JOIN made USING (doc_id, k)),
pair AS (SELECT d.doc_id, d.n, sha256(e.text) AS edited_sha256, own.fp, ed.fp AS edited_fp, len(own.hs) AS n_hashes,
                own.hs AS a, ed.hs AS b, nx.hs AS c, least(own.top, ed.top) AS tb, least(own.top, nx.top) AS tc
         FROM edit d JOIN two e ON e.doc_id = d.doc_id AND e.k = 1 JOIN sketch own ON own.doc_id = d.doc_id AND own.k = 0
         JOIN sketch ed ON ed.doc_id = d.doc_id AND ed.k = 1 JOIN sketch nx ON nx.doc_id = d.next_id AND nx.k = 0),
cut AS (SELECT *, list_filter(a, lambda x: x <= tb) AS ab, list_filter(b, lambda x: x <= tb) AS ba,
               list_filter(a, lambda x: x <= tc) AS ac, list_filter(c, lambda x: x <= tc) AS ca FROM pair)
SELECT doc_id, n AS n_chars, edited_sha256, fp AS fingerprint, edited_fp AS edited_fingerprint,
       CASE WHEN len(a) = 0 OR len(b) = 0 THEN CAST(len(a) = len(b) AS DOUBLE)
            ELSE coalesce(len(list_intersect(ab, ba)) / nullif(least(len(ab), len(ba)), 0), 0.0) END AS near_edited,
       CASE WHEN len(a) = 0 OR len(c) = 0 THEN CAST(len(a) = len(c) AS DOUBLE)
            ELSE coalesce(len(list_intersect(ac, ca)) / nullif(least(len(ac), len(ca)), 0), 0.0) END AS near_next,
       n_hashes
FROM cut
"""


QUERIES |= {"op1_chat_formatting": op1_chat_formatting, "op2_decontamination": op2_decontamination,
            "op3_quality_classifier": op3_quality_classifier,
            "op4_html_extraction": op4_html_extraction, "op5_token_counts": op5_token_counts,
            "op6_quality_rules": op6_quality_rules,
            "op7_license_scan": op7_license_scan, "op8_sharding": op8_sharding,
            "op9_simhash": op9_simhash, "op10_packing": op10_packing,
            "op11_periodic_runs": op11_periodic_runs, "op12_hard_negatives": op12_hard_negatives,
            "op13_fingerprints": op13_fingerprints}
ORACLES |= {"op2_decontamination": OP2_SQL, "op6_quality_rules": OP6_SQL, "op12_hard_negatives": OP12_SQL,
            "op13_fingerprints": OP13_SQL}
