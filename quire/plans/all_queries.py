"""Imports every query module so that the registry is complete."""

from . import (  # noqa: F401
    batch_queries, cleaning_queries, corpus_queries, io_queries, layout_queries, metadata_queries,
    vector_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
