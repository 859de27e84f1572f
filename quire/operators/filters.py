"""Document filters that need metadata or search results (FLT-1, FLT-4,
FLT-6..8, FLT-11, FLT-12, FLT-20, FLT-22).

Parameter lists (blocklists, languages, hosts) are small and fixed by the
caller, so they are inlined as literals: the check is a per-row expression,
no join. Metadata joins are on the document key; a shuffle join on a unique
key has no hot groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lower_list

# Fixed values of the reference's search-result filter.
ONLINE_TEXT = "online text"
ENGLISH = "english"
BLOG_HOST = "blogs.loc.gov"
# Year window of the newspaper batches (range(1865, 1878), end exclusive).
NEWSPAPER_YEARS = (1865, 1877)
# Date window of the collection search.
COLLECTION_YEARS = (1863, 1877)


def _lit_array(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def blocked(collections: Column, blocklist: Iterable[str]) -> Column:
    """True when the (lower-cased) collections intersect the blocklist."""
    block = sorted({b.lower() for b in blocklist})
    return F.coalesce(F.arrays_overlap(lower_list(collections), _lit_array(block)), F.lit(False))


def collection_blocklist(docs: DataFrame, metadata: DataFrame, blocklist: Iterable[str],
                         key: str = "doc_id", collections: str = "collections") -> DataFrame:
    """FLT-4 / JN-2: drop documents whose metadata collections intersect the
    blocklist, case-insensitively. No metadata or null collections: kept."""
    hits = metadata.where(blocked(F.col(collections), blocklist)).select(key)
    return docs.join(hits, key, "left_anti")


def usable_results(results: DataFrame, language: str = ENGLISH, fmt: str = ONLINE_TEXT,
                   excluded_host: str = BLOG_HOST) -> DataFrame:
    """FLT-1 / FN-21: not access-restricted, available as online text, in the
    language, and not hosted on the excluded host (a null host is not it)."""
    host = F.try_parse_url(F.col("id"), F.lit("HOST"))
    return results.where(
        (F.col("access_restricted") == F.lit(False))
        & F.coalesce(F.array_contains(F.col("online_format"), fmt), F.lit(False))
        & F.coalesce(F.array_contains(F.col("language"), language), F.lit(False))
        & ~F.coalesce(host.contains(excluded_host), F.lit(False)))


def path_filter(docs: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """FLT-6 / FLT-7: keep rows whose path matches ``pattern`` (regex search)."""
    return docs.where(F.col(path).rlike(pattern))


def year_range(df: DataFrame, year: Column, first: int, last: int) -> DataFrame:
    """FLT-8 / FLT-20: keep ``first <= year <= last`` (inclusive both ends).
    On a table partitioned by year this prunes partitions."""
    return df.where(year.between(first, last))


def systematic_sample(df: DataFrame, every: int, key: str = "doc_id") -> DataFrame:
    """FLT-11: every ``every``-th document, chosen by a hash of the key so the
    choice does not depend on listing order or partitioning."""
    h = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10)
    return df.where(h.cast("long") % F.lit(every) == 0)


def valid_utf8(df: DataFrame, content: str = "content") -> DataFrame:
    """FLT-12: keep binary contents that decode as UTF-8, as a ``text`` column."""
    return (df.where(F.is_valid_utf8(F.col(content)))
            .withColumn("text", F.col(content).cast("string")))


def title_allow_list(df: DataFrame, allowed: Iterable[str], title: str = "title") -> DataFrame:
    """FLT-21: keep rows whose title contains one of the allowed names,
    case-insensitively (substring match, as a title-suggestion search). The
    list is a parameter, so the match is a per-row expression, not a join."""
    names = sorted({a.lower() for a in allowed})
    t = F.lower(F.col(title))
    return df.where(F.exists(_lit_array(names), lambda a: t.contains(a)))


def restrict_to_found(identifiers: DataFrame, corpus: DataFrame, key: str = "doc_id"
                      ) -> tuple[DataFrame, DataFrame]:
    """FLT-22: ``(found, rejects)``: the wanted identifiers whose text is in the
    corpus, and the others with a reason."""
    wanted = identifiers.select(F.col("identifier")).distinct()
    have = corpus.select(F.col(key).alias("identifier"))
    return (wanted.join(have, "identifier", "left_semi"),
            wanted.join(have, "identifier", "left_anti").withColumn("reason", F.lit("no text found")))
