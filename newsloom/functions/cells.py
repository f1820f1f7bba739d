"""Cell values for text tables: blanks for missing numbers and spelled-out missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DoubleType, FloatType

# Texts that stand for a missing cell, in any case.
MISSING_WORDS = ("nan", "nat", "none")


def finite_or_blank(col: Column) -> Column:
    """A floating-point number as text; NULL, NaN and the infinities are empty."""
    finite = col.isNotNull() & ~F.isnan(col) & (F.abs(col) != F.lit(float("inf")))
    return F.when(finite, col.cast("string")).otherwise("")


def sanitize(col: Column, dtype: DataType, drop_words: bool = True) -> Column:
    """A cell of any type as table text."""
    if isinstance(dtype, (FloatType, DoubleType)):
        return finite_or_blank(col)
    cell = F.coalesce(col.cast("string"), F.lit(""))
    if not drop_words or isinstance(dtype, BooleanType):
        return cell
    return F.when(F.lower(cell).isin(*MISSING_WORDS), "").otherwise(cell)


def to_number(col: Column, default: float) -> Column:
    """Text as a number, `default` where it is none."""
    return F.coalesce(col.cast("string").try_cast("double"), F.lit(float(default)))


def lookup(mapping: dict[str, str], key: Column, default: Column) -> Column:
    """The value for `key` in a small fixed map, `default` for unknown and NULL keys."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)
