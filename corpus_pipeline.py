"""The corpus pipeline: from documents to packed training sequences.

Each stage takes the documents its predecessor kept, calls one operator of
``quire.llm`` and returns the documents it keeps, in their own columns; the last
returns the pieces of the packed sequences. Every stage runs over whole tables
and whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, pack, quality_model, quality_rules, simhash
from quire.llm.common import read_table
from quire.session import remove_stages, stage_scope
from quire.session import stage as staged

MIN_SCORE = 0.3

#: Fingerprint classes, a fitted model and a dynamic program are not SQL; the
#: stages are tested against brute-force versions.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep. Target and
    raw counts are of the documents given; the target are those labelled 1."""
    return quality_rules.filter_documents(docs, read_table(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of ``MIN_SCORE`` or more. The model is
    fitted on the labelled documents of the whole corpus, because the stage
    before has already taken most examples of label 0 away."""
    model = quality_model.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality_model.filter_documents(docs, model, threshold=MIN_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints linked at 3 or fewer bits."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"), mode="documents")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their token ids."""
    return pack.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality rules", rules), ("quality classifier", classifier), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written as
    Parquet in the shared folder and read again as the next stage's documents.
    When it is written, what was staged for it and the documents before are
    removed: one copy of the corpus remains, and a second while a stage runs."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for name, apply in STAGES[:-1]:
        with stage_scope(spark) as used:
            docs = staged(apply(spark, docs, sf_dir), name.replace(" ", "-"))
        remove_stages(spark, before + used[:-1])
        before = used[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
