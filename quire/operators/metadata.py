"""Metadata assembly joins (JN-1, JN-3, JN-6, JN-7, JN-17, FN-11).

Identifiers map many pages to one item record (N:1), and one title can hold a
large share of all pages. The titles that do are measured, and only their records
are copied, by their share, so that their pages are spread over as many tasks
(``skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from ..functions import metadata as M
from ..session import stage
from .skew import spread_join


def fetch_metadata(identifiers: DataFrame, items: DataFrame, key: str = "identifier",
                   existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """JN-6 / JN-7 / FN-11: ``(records, rejects)`` for document keys.

    ``identifiers(key)`` holds page keys or item ids; ``items(identifier,
    item)`` the landed item JSON. Keys already present in ``existing`` are
    skipped (the reference's skip-if-exists). Keys whose item is missing are
    rejected with a reason."""
    ids = identifiers.select(F.col(key).alias("doc_key")).distinct()
    if existing is not None:
        ids = ids.join(existing.select(F.col(key).alias("doc_key")), "doc_key", "left_anti")
    ids = stage(ids.withColumn("lccn", keys.identifier("doc_key")), "identifiers")
    # one record per identifier; of several, the greatest by its JSON text. Rejects ask
    # only whether there is one, so that no item is read, compared or moved for them
    it = (items.groupBy(F.col("identifier").alias("lccn"))
          .agg(F.max_by("item", F.to_json("item")).alias("item"), F.max(F.col("item").isNotNull()).alias("_found")))
    joined = spread_join(ids, it, "lccn", "doc_key")
    records = (joined.where(F.col("item").isNotNull())
               .select("doc_key", F.col("lccn").alias("identifier"),
                       M.item_metadata(F.col("item"), F.col("doc_key")).alias("r"))
               .select("doc_key", "identifier", "r.*"))
    rejects = joined.where(~F.coalesce("_found", F.lit(False))).select(
        "doc_key", F.lit("no item record").alias("reason"))
    return records, rejects


def with_metadata(docs: DataFrame, metadata: DataFrame, key: str = "doc_id") -> DataFrame:
    """JN-1: documents with their metadata where present (left join)."""
    return docs.join(metadata, key, "left")


def documents_with_metadata(docs: DataFrame, metadata: DataFrame,
                            key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """JN-3: ``(joined, missing)`` -- inner join, and the documents skipped
    for lack of metadata (logged by the reference)."""
    return docs.join(metadata, key, "inner"), docs.join(metadata, key, "left_anti").select(key)


def backfill_year(metadata: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """JN-17: ``year = date[:4]`` on records that have a document; other
    records unchanged."""
    has_doc = docs.select(key).distinct().withColumn("_has_doc", F.lit(True))
    out = metadata.join(has_doc, key, "left")
    old = F.col("year") if "year" in metadata.columns else F.lit(None).cast("string")
    return out.withColumn("year", F.when(F.col("_has_doc"), keys.year_of("date"))
                          .otherwise(old)).drop("_has_doc")
