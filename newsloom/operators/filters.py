"""Row filters: brand, relevance, recency, digest windows, flags and keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.dates import DIGEST_HOUR, recent, window_bounds
from newsloom.functions.links import is_unresolved
from newsloom.functions.text import combine_text, contains_any, contains_any_word, fold, fold_flag, let, text


def matches(pattern: str, *cols: Column) -> Column:
    """True when the pattern is found in any column, in any case and with Unicode classes."""
    return reduce(or_, [text(c).rlike(f"(?iuU){pattern}") for c in cols], F.lit(False))


def mentions_brand(df: DataFrame, pattern: str = d.OWN_PATTERN, columns: Sequence[str] = ("title", "snippet")) -> DataFrame:
    return df.where(matches(pattern, *[F.col(c) for c in columns if c in df.columns]))


def mentions_competitor(df: DataFrame, pattern: str = d.COMPETITOR_PATTERN) -> DataFrame:
    return mentions_brand(df, pattern)


def relevance(
    df: DataFrame,
    include: Iterable[str] = d.INCLUDE_TERMS,
    exclude: Iterable[str] = d.EXCLUDE_TERMS,
    columns: Sequence[str] = ("title", "snippet", "article_body"),
    whole_word: bool = False,
) -> DataFrame:
    """Rows with an include term and no exclude term in the joined text, folded once per row."""
    found = contains_any_word if whole_word else contains_any
    folded = fold(combine_text(*[F.col(c) for c in columns if c in df.columns]))
    return df.where(let(folded, lambda t: found(t, include) & ~found(t, exclude)))


def recent_days(df: DataFrame, today: date, days_back: int = 1, day: str = "published_day") -> DataFrame:
    """Rows of today or the `days_back` days before; rows without a date drop."""
    return df.where(recent(F.col(day), today, days_back))


def digest_window(df: DataFrame, now: datetime, stamp: str = "scraped_ts", hour: int = DIGEST_HOUR) -> DataFrame:
    """Rows of the digest that closes on the day of `now`; the range reaches the scan as literals."""
    window = window_bounds(now, hour)
    return df.where((F.col(stamp) >= F.lit(window.start)) & (F.col(stamp) < F.lit(window.end)))


def is_yes(col: Column) -> Column:
    return fold_flag(col) == d.YES


def flagged(df: DataFrame, column: str = "enviar") -> DataFrame:
    """Rows whose editorial flag says yes; tables without the flag pass whole."""
    return df.where(is_yes(F.col(column))) if column in df.columns else df


def unresolved(df: DataFrame, link: str = "link") -> DataFrame:
    return df.where(is_unresolved(F.col(link)))


def has_key(df: DataFrame, key: str = "link_key") -> DataFrame:
    """Drop rows without a canonical link."""
    return df.where(text(F.col(key)) != "")


def has_topic(tema: Column) -> Column:
    """True for any non-empty topic, blanks included."""
    return text(tema) != ""
