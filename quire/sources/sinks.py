"""Sinks (SNK-1..11). Every stage writes a new path (never edits its input in
place, unlike the reference's destructive rewrites); writes go through
Spark's committers, so a lost executor only retries its task."""

from __future__ import annotations

import os
import re
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import path_exists, ship_package


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """SNK-1: a stage's DataFrame as parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text_files(texts: DataFrame, root: str, path: str = "path", text: str = "text") -> None:
    """SNK-1 as a tree of files, one a row, at ``<root>/<path>`` (the layout that the
    page and item readers take). Tasks write their own rows; a file appears under
    its name only when it is whole, so a task can be run again. Null texts give empty
    files, null paths none; of rows with one path any may be the file."""
    ship_package(texts.sparkSession)

    def put(rows) -> None:
        store, base = text_store(root)
        for r in rows:
            place = f"{base}/{r['path']}"
            store.create_dir(place.rsplit("/", 1)[0], recursive=True)
            part = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write((r["text"] or "").encode())
            store.move(part, place)

    picked = texts.select(F.col(path).alias("path"), F.col(text).alias("text")).where("path IS NOT NULL")
    picked.foreachPartition(put)


def text_store(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``root`` and its path there."""
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(root)
    place = re.sub(r"^file:/+", "file:///", re.sub(r"^s3[an]:", "s3:", root))
    store, base = pafs.FileSystem.from_uri(place)
    return store, base.rstrip("/")


def write_metadata_json(records: DataFrame, path: str, key: str = "identifier") -> None:
    """SNK-2: one ``{identifier: record}`` JSON object per line."""
    fields = [c for c in records.columns if c not in (key, "doc_key")]
    records.select(F.to_json(F.create_map(F.col(key), F.struct(*fields))).alias("value")) \
        .write.mode("overwrite").text(path)


def write_labelled_csv(labelled: DataFrame, path: str) -> None:
    """SNK-3: CSV with a header; lists are already JSON text (D20)."""
    labelled.write.mode("overwrite").option("header", True).csv(path)


def write_coordinates(coords: DataFrame, path: str, key: str = "doc_id") -> None:
    """SNK-4 / SNK-5: coordinates with their key in the same row, so no
    separate row-order id file is needed."""
    coords.select(key, "x", "y").write.mode("overwrite").option("header", True).csv(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """SNK-8: the reject log of a run as a table ``(key, reason)``; a rerun
    replaces it."""
    rejects.write.mode("overwrite").parquet(path)


def subject_log(results: DataFrame, subject: str = "subject") -> DataFrame:
    """SNK-9: one row per subject occurrence of the kept results."""
    return results.select(F.explode_outer(F.col(subject)).alias("subject"))


def write_tiles(tiles: DataFrame, path: str) -> None:
    """SNK-10: tiles partitioned by (z, tx, ty, page), one file a page, whose rows are
    at most a tile's; ``date`` stays a string."""
    out = tiles.repartition("z", "tx", "ty", "page")
    if "date" in tiles.columns:
        out = out.withColumn("date", F.col("date").cast("string"))
    out.write.mode("overwrite").partitionBy("z", "tx", "ty", "page").parquet(path)


def write_new_only(df: DataFrame, path: str, key: str, overwrite: bool = False) -> None:
    """SNK-11 / JN-7: skip rows whose key is already in the output, unless
    ``overwrite``; new rows are appended. Only a missing path counts as a first
    write; an output that cannot be read, or has no key column, is an error and
    stays as it is."""
    spark = df.sparkSession
    if overwrite:
        df.write.mode("overwrite").parquet(path)
    elif path_exists(spark, path):
        existing = spark.read.parquet(path)
        if key not in existing.columns:
            raise ValueError(f"{path} has no column {key!r}")
        df.join(existing.select(key), key, "left_anti").write.mode("append").parquet(path)
    else:
        df.write.mode("errorifexists").parquet(path)


def write_vocabulary(freq: DataFrame, path: str) -> None:
    """SNK-7: term / document frequencies for later training runs (AGG-13)."""
    freq.write.mode("overwrite").parquet(path)


def write_corrections(corrections: DataFrame, root: str, model_id: str) -> None:
    """SRC-13 / D3: the correction table, kept per model id (the reference's
    cache was never committed)."""
    corrections.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{model_id}")


def write_bucketed(df: DataFrame, table_name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A stage saved as a table bucketed and sorted by its key: later joins
    and aggregations on the key between tables with the same bucket count
    read co-located buckets and skip the shuffle. ``path`` places the table
    files explicitly (an external table), otherwise in the warehouse."""
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table_name)
