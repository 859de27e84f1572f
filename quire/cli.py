"""Command-line entry point: run the corpus-to-map job over landed files.

    python -m quire map --pages DIR --results DIR --metadata DIR \\
        --dictionary FILE --keywords war,cotton --out DIR [--vectors DIR]

Every stage is written under ``--out`` (parquet stages, a labelled CSV,
coordinates CSV, tiles) -- inputs are never edited in place. On a cluster
the session comes from ``spark-submit`` and its ``spark.checkpoint.dir``
is used; locally a session is created.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import CorpusConfig
from .operators import cleaning
from .plans.end_to_end import MapOptions, corpus_map
from .session import build_session
from .sources import files, sinks


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("map", help="corpus -> labelled, shuffled and tiled map")
    m.add_argument("--pages", help="page text tree (<key>/ocr.txt)")
    m.add_argument("--results", help="item text directory")
    m.add_argument("--page-regex", help="only pages whose path matches (e.g. /1877/)")
    m.add_argument("--metadata", required=True, help="metadata JSON tree")
    m.add_argument("--dictionary", required=True, help="word list (one per line) or parquet")
    m.add_argument("--keywords", default="", help="comma-separated keywords to score")
    m.add_argument("--vectors", help="directory of a saved model (word_vectors, doc_vectors)")
    m.add_argument("--previous-vectors", help="model whose word vectors repair nonwords")
    m.add_argument("--tile-size", type=int, default=25_000)
    m.add_argument("--frontmatter-lines", type=int, default=cleaning.FRONTMATTER_LINES,
                   help="lines dropped from the top of every page")
    m.add_argument("--archival-lines", type=int, default=cleaning.ARCHIVAL_LINES,
                   help="lines dropped from items that carry an archival note")
    m.add_argument("--words-to-examine", type=int,
                   help="judge only the first words of a text (the reference: 400); default all")
    m.add_argument("--epochs", type=int, default=40, help="iterations of the training")
    m.add_argument("--min-count", type=int, default=25, help="training vocabulary threshold")
    m.add_argument("--vocabulary", help="saved word frequencies (word, tf) to train on")
    m.add_argument("--min-frequency", type=int, help="train words seen more often than this")
    m.add_argument("--buckets", type=int, default=0,
                   help="write doc-keyed stages as tables bucketed by doc_id (co-located joins)")
    m.add_argument("--no-key", action="store_true",
                   help="labelled CSV without the doc_id column (header starts x, y)")
    m.add_argument("--out", required=True)
    m.add_argument("--master", help="local master for runs outside spark-submit")
    return p


def run_map(spark: SparkSession, a: argparse.Namespace) -> dict:
    cfg = CorpusConfig(newspaper_dir=a.pages, results_dir=a.results, newspaper_dir_regex=a.page_regex,
                       vocabulary=a.vocabulary, min_frequency=a.min_frequency,
                       epochs=a.epochs, model_options={"minCount": a.min_count})
    docs = cfg.documents(spark).select("doc_id", "kind", "text")
    records, rejects = files.read_metadata(spark, a.metadata)
    # a page's metadata file sits at its page key; an item's at its id
    meta = records.withColumn("doc_id", F.col("doc_key"))
    dictionary = files.read_dictionary(spark, a.dictionary)
    prev = spark.read.parquet(f"{a.previous_vectors}/word_vectors") if a.previous_vectors else None
    wv = dv = None
    if a.vectors:
        wv = spark.read.parquet(f"{a.vectors}/word_vectors")
        dv = spark.read.parquet(f"{a.vectors}/doc_vectors")
    keywords = [k for k in a.keywords.split(",") if k]
    opts = MapOptions(keywords=keywords, tile_size=a.tile_size, include_key=not a.no_key,
                      frontmatter_lines=a.frontmatter_lines, archival_lines=a.archival_lines,
                      words_to_examine=a.words_to_examine)
    out = a.out.rstrip("/")

    def save(df, name):
        """Each stage is written once, under --out, and read from there."""
        if a.buckets and name in ("cleaned", "documents", "metadata", "coordinates"):
            sinks.write_bucketed(df, f"quire_{name}", "doc_id", a.buckets, f"{out}/{name}")
            return spark.table(f"quire_{name}")
        sinks.write_stage(df, f"{out}/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    stages = corpus_map(docs, meta, dictionary, opts, config=cfg,
                        previous_vectors=prev, word_vectors=wv, doc_vectors=dv, save=save)
    sinks.write_rejects(rejects, f"{out}/rejects")
    sinks.write_coordinates(stages["coordinates"], f"{out}/coordinates_csv")
    sinks.write_labelled_csv(stages["labelled"], f"{out}/labelled_csv")
    if "tiles" in stages:
        sinks.write_tiles(stages["tiles"], f"{out}/tiles")
    return stages


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session(a.master or "local[*]")
    if a.command == "map":
        run_map(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
