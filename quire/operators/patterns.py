"""Many names looked for in many texts (FLT-21, marker filters).

A hit is a place (from 1, in code points) at which a name occurs in a text, both in
lower case; occurrences may overlap or lie inside each other. Names are taken once
however often they are listed; null and empty names and null texts have no hits.

The size of the names decides the way, and both give the same hits:

* up to ``AUTOMATON_BYTES`` of distinct names are sent to the tasks once, which build
  an Aho-Corasick automaton and keep it for the life of the worker: one pass a text,
  whatever the number of names;
* more of them stay a table. A name has a prefix of as many code points as the
  greatest power of two in its length. Texts are cut into pieces at every place, one
  for each prefix length in use, both sides are shuffled by prefix, and the rest of
  the name is compared. Prefix lengths are at most some twenty numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ship_package, stage

AUTOMATON_BYTES = 4 << 20
# Steps in which a text is cut down to its places: a place in a string is found by
# walking to it, so cutting a long text at every place at once would be quadratic.
CUTS = (1 << 20, 1 << 14, 1 << 7, 1)

HITS = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("place", T.IntegerType())]))

_KEPT: dict = {}  # this worker's last automaton, by the id of its names


def build(names: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for n in names:
        found.add_word(n, n)
    found.make_automaton()
    return found


def hits_of(automaton: ahocorasick.Automaton, text: str | None) -> list[dict]:
    if not text or not len(automaton):
        return []
    return [{"name": n, "place": end - len(n) + 2} for end, n in automaton.iter(text)]


def distinct_names(names: DataFrame, name: str) -> DataFrame:
    low = F.lower(F.col(name))
    return names.select(low.alias("name")).where(F.length("name") > 0).distinct()


def hits_column(listed: DataFrame, text: Column) -> Column:
    """The hits of distinct ``listed(name)``, of a size the caller has checked."""
    ship_package(listed.sparkSession)
    sent = listed.sparkSession.sparkContext.broadcast([r["name"] for r in listed.collect()])
    key, kind = uuid.uuid4().hex, to_arrow_type(HITS)

    @F.arrow_udf(HITS)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _KEPT:
            _KEPT.clear()
            _KEPT[key] = build(sent.value)
        for batch in texts:
            yield pa.array([hits_of(_KEPT[key], t) for t in batch.to_pylist()], kind)

    return find(F.lower(text))


def _by_prefix(texts: DataFrame, listed: DataFrame, key: str, text: str) -> DataFrame:
    size = F.length("name")
    listed = stage(listed.withColumn("n", F.pow(F.lit(2), F.floor(F.log2(size))).cast("int"))
                   .withColumn("prefix", F.expr("substring(name, 1, n)")), "names")
    used = [r["n"] for r in listed.select("n").distinct().collect()]  # powers of two
    longest = listed.agg(F.max(size)).first()[0] or 0
    low = F.lower(F.col(text))
    at = texts.select(F.col(key).alias("key"), F.lit(0).alias("before"), F.length(low).alias("own"), low.alias("rest"))
    for step in CUTS:  # each piece with the places that it owns and as much text as a name from the last may need
        at = at.where("own > 0").withColumn("skip", F.explode(F.sequence(F.lit(0), F.col("own") - 1, F.lit(step))))
        at = at.select("key", (F.col("before") + F.col("skip")).alias("before"),
                       F.least(F.lit(step), F.col("own") - F.col("skip")).alias("own"),
                       F.substring("rest", F.col("skip") + 1, F.lit(step + longest - 1)).alias("rest"))
    at = at.select("key", (F.col("before") + 1).alias("place"), "rest")
    pieces = at.select("key", "place", "rest", F.explode(F.array(*[F.lit(n) for n in used]).cast("array<int>")).alias("n"))
    pieces = (pieces.where(F.length("rest") >= F.col("n"))
              .withColumn("prefix", F.expr("substring(rest, 1, n)")))
    return (pieces.join(listed, ["n", "prefix"]).where(F.startswith("rest", "name"))
            .select(F.col("key").alias(key), "name", "place"))


def _fits(listed: DataFrame, most: int) -> bool:
    return (listed.agg(F.sum(F.octet_length("name"))).first()[0] or 0) <= most


def title_matches(titles: DataFrame, names: DataFrame, key: str = "doc_id", title: str = "title", name: str = "name",
                  automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """``(key, name, place)``: every hit of every name in every title."""
    listed = stage(distinct_names(names, name), "names")
    if not _fits(listed, automaton_bytes):
        return _by_prefix(titles, listed, key, title)
    return (titles.select(F.col(key), F.explode(hits_column(listed, F.col(title))).alias("hit"))
            .select(key, "hit.name", "hit.place"))


def titles_with_names(titles: DataFrame, names: DataFrame, title: str = "title", name: str = "name",
                      automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """FLT-21 for a table of names: the rows whose title holds one of them."""
    listed = stage(distinct_names(names, name), "names")
    if _fits(listed, automaton_bytes):
        return titles.where(F.size(hits_column(listed, F.col(title))) > 0)
    found = _by_prefix(titles.select(title).distinct().withColumn("key", F.col(title)), listed, "key", title)
    found = found.select(F.col("key").alias("_found")).distinct()
    return titles.join(found, F.col(title) == F.col("_found"), "left_semi")
