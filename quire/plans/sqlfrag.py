"""DuckDB SQL fragments shared by the oracle queries.

The oracles are written independently of the Spark code: plain SQL over the
same parquet tables, used by the correctness check.
"""

from __future__ import annotations

from ..functions.text import PUNCTUATION


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PUNCT_SQL = sql_str(PUNCTUATION)


def normalize(expr: str) -> str:
    return f"translate(lower({expr}), {PUNCT_SQL}, '')"


def split_ws(expr: str) -> str:
    # RE2's \s is ASCII whitespace; the test corpus has no other whitespace.
    return f"list_filter(regexp_split_to_array({expr}, '\\s+'), lambda x: x <> '')"


def tokens(expr: str) -> str:
    return split_ws(normalize(expr))
