"""Join helper for token lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import stage


def lookup_join(big: DataFrame, lookup: DataFrame, key: str, how: str = "left",
                stored: bool = False) -> DataFrame:
    """Join a large row stream to a keyed lookup table, one plan at every size.

    The lookup table is written once as Parquet, so its size in bytes is known
    to the planner: Spark broadcasts it below the session's broadcast threshold
    and otherwise shuffles both sides, where adaptive execution splits the
    partitions that a hot key (a word like "the") has made too large. No hint
    overrides that. ``stored``: the lookup already reads a stored table."""
    return big.join(lookup if stored else stage(lookup, "lookup"), key, how)
