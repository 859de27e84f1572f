"""Document keys, paths and URLs as Column expressions (FN-1..7, FN-12, FN-13).

A page key looks like ``<lccn>/<yyyy>/<mm>/<dd>/ed-<n>/seq-<n>`` and may sit
inside a longer path (``root/…/ocr.txt``); anything else is an item key whose
identifier is its last path segment.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's key handling.
PAGE_KEY_RE = r"(\w+)/\d{4}/\d{2}/\d{2}/ed-\d/seq-\d"
DATE_RE = r"(\d{4})/(\d{2})/(\d{2})"
PAGE_URL_BASE = "https://chroniclingamerica.loc.gov/lccn/"
THUMBNAIL = "thumbnail.jpg"
OCR_FILE = "ocr.txt"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_page(key) -> Column:
    """FN-1: the key contains a page key (regex *search*)."""
    return _c(key).rlike(PAGE_KEY_RE)


def kind(key) -> Column:
    return F.when(is_page(key), F.lit("page")).otherwise(F.lit("item"))


def last_segment(key) -> Column:
    """FN-12: last non-empty ``/`` segment."""
    return F.element_at(F.filter(F.split(_c(key), "/"), lambda s: s != F.lit("")), -1)


def identifier(key) -> Column:
    """FN-2: page -> the lccn (group 1 of the page pattern); item -> basename."""
    k = _c(key)
    return F.when(is_page(k), F.trim(F.regexp_extract(k, PAGE_KEY_RE, 1))).otherwise(last_segment(k))


def page_path(key) -> Column:
    """FN-3: the key from the identifier on, without ``ocr.txt``."""
    k = _c(key)
    ident = F.regexp_extract(k, PAGE_KEY_RE, 1)
    return F.replace(k.substr(F.instr(k, ident), F.length(k)), F.lit(OCR_FILE), F.lit(""))


def page_date(key) -> Column:
    """FN-4: ``yyyy/mm/dd`` in the key -> ``yyyy-mm-dd``."""
    k = _c(key)
    return F.when(k.rlike(DATE_RE), F.concat_ws(
        "-", F.regexp_extract(k, DATE_RE, 1), F.regexp_extract(k, DATE_RE, 2),
        F.regexp_extract(k, DATE_RE, 3)))


def year_of(date) -> Column:
    """FN-5: first four characters of a ``YYYY`` / ``YYYY-MM-DD`` string."""
    return F.substring(_c(date), 1, 4)


def page_url(key) -> Column:
    """FN-6: page URL: the page path with dates written ``yyyy-mm-dd``."""
    return F.concat(F.lit(PAGE_URL_BASE), F.regexp_replace(page_path(key), DATE_RE, "$1-$2-$3"))


def thumbnail_url(url) -> Column:
    """FN-7: always append the thumbnail segment (the reference's ``urljoin``
    replaced the last segment unless the URL ended in ``/``: D17)."""
    return F.concat(F.regexp_replace(_c(url), "/+$", ""), F.lit("/" + THUMBNAIL))


def doc_key(path, root: str = "") -> Column:
    """FN-13: file path -> document key: strip ``root`` and ``ocr.txt`` and
    surrounding slashes."""
    p = _c(path)
    if root:
        p = F.when(p.startswith(root), F.substring(p, len(root) + 1, 1 << 30)).otherwise(p)
    p = F.replace(p, F.lit(OCR_FILE), F.lit(""))
    return F.regexp_replace(p, "^/+|/+$", "")
