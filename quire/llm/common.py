"""Helpers shared by the training-data operators.

Conventions of every operator here: it selects the columns it needs by name,
so further input columns never reach Python and may carry any name (rows that are
returned whole travel as one struct, see ``packed_row``); a column that the
operator adds replaces an input column of the same name; a null text
is treated as the empty text unless the operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table as Spark splits it (no repartitioning)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_rows(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``mapInArrow`` with the package on the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(task, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Deterministic fold flag: crc32 of the key's text divisible by ``folds``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds) == F.lit(0)


def quoted(name: str) -> str:
    """A column's name as Spark reads it literally, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def packed_row(docs: DataFrame, **wanted: str) -> DataFrame:
    """Each row as one struct ``row``, and the wanted columns under names of the
    operator's own: whatever it adds, no column of the input can clash with it."""
    whole = F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")
    return docs.select(whole, *[F.col(quoted(c)).alias(name) for name, c in wanted.items()])


def unpacked_row(rows: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The columns of the packed rows again, but for those of the same names
    (case-insensitive, as Spark resolves them) as the columns added."""
    taken = {n.lower() for n in added}
    return rows.select(*[F.col(f"row.{quoted(c)}") for c in columns if c.lower() not in taken],
                       *[c.alias(n) for n, c in added.items()])


def drop_clashes(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (case-insensitive,
    as Spark resolves names)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in taken])
