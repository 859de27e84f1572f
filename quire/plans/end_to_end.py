"""Corpus to map, end to end (VIZ-4).

Composes the stages in the reference's order and with its scoping: quality
filter (all) -> front matter (pages) -> archival notes and attribution lines
(items) -> nonword correction with a *previous* model's vectors (all) ->
per-document location stopwords (pages) -> drop empties -> vectors (given, or
trained) -> keyword scores -> layout -> labelled table -> shuffle -> tiles.

Every stage that is read more than once is written once as Parquet (by
``save``; by default into the session's shared folder) and read back pruned, so
a lost executor does not recompute the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CorpusConfig
from ..functions import keys
from ..functions import text as T
from ..functions.text import ARCHIVAL_MARKER_RE, TRANSCRIPTION_ATTRIBUTION
from ..operators import cleaning, corrections, layout, quality, scoring, tiles, training, vocab
from ..session import stage as write_stage

PAGE, ITEM = "page", "item"


@dataclass(frozen=True)
class MapOptions:
    keywords: Sequence[str] = ()
    quality_cutoff: float = quality.CUTOFF
    words_to_examine: int | None = None
    archival_marker: str = ARCHIVAL_MARKER_RE
    archival_lines: int = cleaning.ARCHIVAL_LINES
    attribution: str = TRANSCRIPTION_ATTRIBUTION
    frontmatter_lines: int = cleaning.FRONTMATTER_LINES
    correction_threshold: float = corrections.SIMILARITY_THRESHOLD
    layout_seed: int = 0
    tile_size: int | None = None
    include_key: bool = True


def clean_by_kind(docs: DataFrame, options: MapOptions, text: str = "text") -> DataFrame:
    """Line edits as the reference scopes them: pages lose their first lines;
    items lose the first lines if they carry an archival note, and every
    attribution line."""
    t = F.col(text)
    item = T.drop_matching_lines(
        F.when(T.has_marker_line(t, options.archival_marker), T.drop_first_lines(t, options.archival_lines))
        .otherwise(t), options.attribution)
    return docs.withColumn(text, F.when(F.col("kind") == PAGE, T.drop_first_lines(t, options.frontmatter_lines))
                           .otherwise(item))


def corpus_map(docs: DataFrame, metadata: DataFrame, dictionary: DataFrame, options: MapOptions,
               config: CorpusConfig | None = None, previous_vectors: DataFrame | None = None,
               word_vectors: DataFrame | None = None, doc_vectors: DataFrame | None = None,
               key: str = "doc_id", save: Callable[[DataFrame, str], DataFrame] = write_stage
               ) -> dict[str, DataFrame]:
    """Run every stage; returns the stage DataFrames by name.

    ``docs(key, text[, kind])`` (``kind`` is read off the key if absent),
    ``metadata(key, <METADATA_ORDER fields>, keyword_scores)``,
    ``dictionary(word)``. ``previous_vectors`` drive the nonword step;
    ``word_vectors`` / ``doc_vectors`` default to a model trained on the cleaned
    corpus. ``save(df, name)`` stores a stage and returns it as stored."""
    config = config or CorpusConfig()
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        out[name] = save(df, name)
        return out[name]

    if "kind" not in docs.columns:
        docs = docs.withColumn("kind", keys.kind(key))
    docs = docs.select(key, "kind", "text")
    dictionary = write_stage(dictionary.select("word").distinct(), "dictionary")
    good = quality.quality_filter(docs, dictionary, cutoff=options.quality_cutoff, key=key,
                                  words_to_examine=options.words_to_examine, stored=True).select(key)
    d = keep("cleaned", clean_by_kind(docs.join(good, key, "left_semi"), options))

    if previous_vectors is not None:
        corr = keep("corrections", corrections.derive_corrections(
            corrections.nonwords_of(d, dictionary), previous_vectors, dictionary,
            threshold=options.correction_threshold))
        d = corrections.replace_nonwords(d, dictionary, corr, key=key).join(d.select(key, "kind"), key)

    stop = metadata.select(key, cleaning.metadata_stopwords(F.col("title"), F.col("locations")).alias("_words"))
    d = d.join(stop, key, "left").withColumn("_stop", F.when(F.col("kind") == PAGE, F.col("_words"))).drop("_words")
    d = keep("documents", cleaning.drop_empty(cleaning.remove_document_stopwords(d, "_stop", key=key)))

    if word_vectors is None or doc_vectors is None:
        toks = write_stage(d.select(key, config.tokens("text").alias("tokens")), "tokens")
        given = word_vectors is not None
        word_vectors = word_vectors if given else write_stage(config.train(toks), "model")
        if doc_vectors is None and given:  # any model's vectors: their mean
            doc_vectors = training.mean_vectors(word_vectors, toks, key, size=config.model()["vectorSize"])
        elif doc_vectors is None:
            doc_vectors = config.document_vectors(word_vectors, toks, key)
    wv = keep("word_vectors", word_vectors)
    doc_vectors = doc_vectors.join(d.select(key), key, "left_semi")

    scores = scoring.keyword_scores(d, wv, list(options.keywords), key=key)
    meta = scoring.upsert_scores(metadata.join(d.select(key), key, "left_semi"), scores, key)
    meta = keep("metadata", meta)

    first = doc_vectors.select(F.size("vector")).first()  # the dimension; no row, no dimension
    coords = keep("coordinates", layout.random_projection(
        doc_vectors, first[0] if first else config.model()["vectorSize"], options.layout_seed, key=key))
    placed = coords.where(F.col("x").isNotNull())  # a zero vector has no place on the map
    lab = keep("labelled_rows", layout.labelled_table(placed, meta, list(options.keywords), key=key))
    shuffled = layout.shuffled(lab, key, stored=True)
    out["labelled"] = shuffled if options.include_key else shuffled.drop(key)
    if options.tile_size:
        out["tiles"] = tiles.quadtree_tiles(lab, layout.shuffle_key(key), key=key, tile_size=options.tile_size)
    return out
