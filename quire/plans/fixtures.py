"""How the reference's inputs map onto the driver's tables.

Metadata records exist only for documents that have a row in ``labels``, so
the "no metadata" branches of the operators are exercised too:

* title       = the document's first line
* locations   = [source, lang]
* collections = [source, lang]

Dates and years are exercised on page keys built from ``orders`` (see
``metadata_queries``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table


def corpus_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, title, locations, collections)`` for labelled documents."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id")
    return (docs.join(labels, "doc_id", "left_semi")
            .select("doc_id",
                    F.split(F.col("text"), "\n", -1).getItem(0).alias("title"),
                    F.array("source", "lang").alias("locations"),
                    F.array("source", "lang").alias("collections")))


SQL_METADATA = """meta AS (
    SELECT d.doc_id, string_split(d.text, chr(10))[1] AS title,
           [d.source, d.lang] AS locations, [d.source, d.lang] AS collections
    FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id)"""
