"""Sheet-like rows: ragged cells, headers and key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_ragged(rows: DataFrame, header: Sequence[str], cells: str = "cells", keep: Sequence[str] = ()) -> DataFrame:
    """Named columns from cell arrays: short rows are padded with blanks, long rows are cut."""
    return rows.select(*keep, *[F.coalesce(F.get(cells, i), F.lit("")).alias(name) for i, name in enumerate(header)])


def resolve_key_column(header: Sequence[str], name: str, default_header: Sequence[str]) -> str | None:
    """The header's own spelling of `name`: exact, else in any case, else by the default position
    when the widths agree, else None."""
    if name in header:
        return name
    lowered = [column.lower() for column in header]
    if name in lowered:
        return header[lowered.index(name)]
    if len(header) == len(default_header) and name in default_header:
        return header[list(default_header).index(name)]
    return None


def key_column(df: DataFrame, name: str, default_header: Sequence[str], alias: str = "link_key") -> DataFrame:
    """The keys of a table whose header may be spelled differently; no rows when there is none."""
    found = resolve_key_column(df.columns, name, default_header)
    if found is None:
        return df.select(F.lit("").alias(alias)).limit(0)
    return df.select(F.col(f"`{found}`").alias(alias))
