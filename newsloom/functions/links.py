"""Canonical links, redirect ids and stored resolver responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import clean_value, strip, text

# The endings that mark a mobile copy of a page, and signs of an unresolved redirect.
COPY_ENDING = r"(/amp/?|=amp|=amp-type|\?outputType|\?outputType=amp-type|\.amp|/)\z"
REDIRECT_SIGNS = ("news.google.com", "/goto?url=")
ARTICLE_ID_PATTERNS = (r"articles/([^?]+)", r"url=([^&]+)")
SIGNATURE_PATTERN = r'data-n-a-sg="([^"]+)"'
STAMP_PATTERN = r'data-n-a-ts="([^"]+)"'
RESOLVED_PATTERN = r'\["garturlres","([^"]*)"'


def normalize_link_suffix(url: Column, passes: int = 1) -> Column:
    """Trim and remove one copy ending per pass. The rule is not idempotent, so passes matter."""
    link = text(url)
    for _ in range(passes):
        link = F.regexp_replace(strip(link), COPY_ENDING, "")
    return link


def strip_query_fragment(url: Column) -> Column:
    """Trim, cut at the first `?` or `#`, drop all trailing slashes."""
    return F.regexp_replace(F.regexp_replace(clean_value(url), r"[?#].*", ""), r"/+\z", "")


def url_key(url: Column) -> Column:
    """The link as a lookup key: trimmed only."""
    return clean_value(url)


def is_unresolved(link: Column) -> Column:
    """True for redirects that still need resolving; NULL and empty are false."""
    checks = [F.contains(text(link), F.lit(sign)) for sign in REDIRECT_SIGNS]
    return checks[0] | checks[1]


def _first_group(col: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def article_id(link: Column) -> Column:
    """The redirect's article id, NULL when the link carries none."""
    return F.coalesce(*[_first_group(link, pattern) for pattern in ARTICLE_ID_PATTERNS])


def extract_signature(page: Column) -> Column:
    """Signature and time stamp of a stored redirect page; NULL unless both are there."""
    signature, stamp = _first_group(page, SIGNATURE_PATTERN), _first_group(page, STAMP_PATTERN)
    return F.when(
        signature.isNotNull() & stamp.isNotNull(),
        F.struct(signature.alias("signature"), stamp.alias("stamp")),
    )


def extract_resolved_url(response: Column) -> Column:
    """The target url in a stored resolver response, NULL when there is none."""
    return _first_group(response, RESOLVED_PATTERN)
