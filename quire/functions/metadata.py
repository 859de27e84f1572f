"""Metadata record projections (FN-8..11, FN-22, FN-23, ORD-5).

Input is the item JSON (``item`` struct, see ``sources.json_sources``);
output is the flat metadata record keyed by identifier.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import keys

# The 50 US states matched against title-cased locations
# (the reference fused "Arkansas" and "California" by a missing comma, D16;
# here they are separate).
STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii", "Idaho",
    "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine",
    "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi",
    "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina",
    "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
    "Washington", "West Virginia", "Wisconsin", "Wyoming",
)

# Column order of the labelled output table, the key of the
# score map inside a record, and the URL mark of a collection.
METADATA_ORDER = (
    "collections", "title", "subjects", "subject_headings", "locations", "date",
    "url", "image_url", "description", "states", "year",
)
SCORE_NAMESPACE = "keyword_scores"
COLLECTION_URL_MARK = "/collections/"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collections_from_partof(partof) -> Column:
    """FN-8: titles of the ``partof`` entries whose url is a collection; null
    when any entry has no url or there is no list, as in the reference."""
    entries = _c(partof)
    return F.when(~F.exists(entries, lambda p: p["url"].isNull()), F.transform(
        F.filter(entries, lambda p: p["url"].contains(COLLECTION_URL_MARK)), lambda p: p["title"]))


def dedup_locations(location) -> Column:
    """FN-9: distinct locations, [] when missing."""
    return F.coalesce(F.array_distinct(_c(location)), F.array().cast("array<string>"))


def states_in(locations, states: Iterable[str] = STATES) -> Column:
    """FN-10: title-cased locations that are states (set intersection)."""
    ref = F.array(*[F.lit(s) for s in sorted(set(states))]).cast("array<string>")
    return F.array_intersect(F.transform(_c(locations), lambda x: F.initcap(x)), ref)


def first_image(image_url) -> Column:
    """ORD-5: first image url of the list (null when absent or empty)."""
    return F.try_element_at(_c(image_url), F.lit(1))


def score_of(scores, word: str) -> Column:
    """FN-22: one keyword score (null when absent)."""
    return F.try_element_at(_c(scores), F.lit(word))


def unwrap(record_map, identifier) -> Column:
    """FN-23: the inner record of ``{identifier: record}``."""
    return F.try_element_at(_c(record_map), _c(identifier))


def item_metadata(item, key, states: Iterable[str] = STATES) -> Column:
    """FN-11: the metadata record of one item or page.

    Common fields come from the item JSON; pages take date, year, url and
    image url from their key. A missing date leaves year null (D18)."""
    it = _c(item)
    k = _c(key)
    page = keys.is_page(k)
    locations = dedup_locations(it["location"])
    date = F.when(page, keys.page_date(k)).otherwise(it["date"])
    url = F.when(page, keys.page_url(k)).otherwise(it["url"])
    image = F.when(page, keys.thumbnail_url(keys.page_url(k))).otherwise(first_image(it["image_url"]))
    return F.struct(
        collections_from_partof(it["partof"]).alias("collections"),
        it["title"].alias("title"),
        it["subjects"].alias("subjects"),
        it["subject_headings"].alias("subject_headings"),
        locations.alias("locations"),
        date.alias("date"),
        url.alias("url"),
        image.alias("image_url"),
        it["description"].alias("description"),
        states_in(locations, states).alias("states"),
        keys.year_of(date).alias("year"),
        F.create_map().cast("map<string,int>").alias(SCORE_NAMESPACE),
    )
