"""Parquet table access for the driver-supplied corpus and star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Row key of the tables that carry per-row work (text, vectors).
KEYS = {
    "documents": "doc_id",
    "pages": "page_id",
    "conversations": "conv_id",
    "embeddings": "vec_id",
    "benchmark": "item_id",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table. Column pruning and filters in later steps are
    pushed into this scan by Catalyst. Rows stay as Spark splits the files,
    unless the session asks for a number of partitions (see ``build_session``)."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    parts = spark.conf.get("spark.quire.scan.partitions", None)
    return df.repartition(int(parts), KEYS[name]) if parts and name in KEYS else df
