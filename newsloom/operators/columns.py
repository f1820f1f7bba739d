"""Feed columns: lineage stamps, defaults, fixed headers, countries and table text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.cells import lookup, sanitize
from newsloom.functions.text import clean_value


def tag_source(df: DataFrame, country: str, query: str, scraped_at: str) -> DataFrame:
    """Stamp where and when a feed was read."""
    return df.withColumns({"country": F.lit(country), "query": F.lit(query), "scraped_at": F.lit(scraped_at)})


def ensure_columns(df: DataFrame, columns: Sequence[str], default: str = "", fill_null: bool = False) -> DataFrame:
    """Add the missing columns; with `fill_null`, NULLs in the present ones get the default too."""
    added = {c: F.lit(default) for c in columns if c not in df.columns}
    filled = {c: F.coalesce(F.col(c), F.lit(default)) for c in columns if c in df.columns} if fill_null else {}
    return df.withColumns({**added, **filled}) if added or filled else df


def conform(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Exactly the header's columns, in its order."""
    return ensure_columns(df, header).select(*header)


def map_country(code: Column, names: Mapping[str, str] = d.COUNTRY_NAMES) -> Column:
    """Country code to name; unknown codes pass through."""
    return lookup(dict(names), code, code)


def country_flag(name: Column, flags: Mapping[str, str] = d.COUNTRY_FLAGS) -> Column:
    return lookup(dict(flags), clean_value(name), F.lit(""))


def sanitize_cells(df: DataFrame, drop_words: bool = True) -> DataFrame:
    """Every column as table text; `drop_words=False` keeps spelled-out missing values."""
    return df.select(*[sanitize(F.col(f.name), f.dataType, drop_words).alias(f.name) for f in df.schema])
