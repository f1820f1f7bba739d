"""Keep-first deduplication, distinct links and per-source caps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.ranking import ordered_position

#: Spark's default for `spark.sql.optimizer.windowGroupLimitThreshold`.
WINDOW_ROWS = 1000


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """The first `n` rows per key in a total order.

    Spark limits every group before the shuffle as well as after it, so a key that holds a large
    share of the rows sends at most `n` rows per input partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def dedupe_by_link(df: DataFrame, order: Sequence[Column | str], key: str = "link_key") -> DataFrame:
    """One row per canonical link; all rows without a link count as one."""
    return first_rows(df, [key], order)


def content_hash(columns: Sequence[str]) -> Column:
    """A cryptographic hash of texts: two rows have the same one if and only if the texts are the same, NULLs included."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))


def dedupe_by_content(df: DataFrame, order: Sequence[Column | str], columns: Sequence[str] = ("title", "snippet")) -> DataFrame:
    """One row per title and snippet, which are compared by a hash of both.

    A copy that cannot come first leaves its task before the shuffle, so texts are moved once at most.
    """
    return first_rows(df.withColumn("_content", content_hash(columns)), ["_content"], order).drop("_content")


def distinct_links(df: DataFrame, link: str = "link") -> DataFrame:
    return df.where(F.col(link).isNotNull()).select(link).distinct()


def source_cap(
    df: DataFrame,
    order: Sequence[Column | str],
    max_items: int,
    source: Sequence[str] = ("query", "country"),
) -> DataFrame:
    """At most `max_items` rows per source, a positive number that the caller must give.

    Up to `WINDOW_ROWS`, which Spark limits in every task before the shuffle, a window finds them. For
    higher caps it would sort a whole source in one task; there rows get their places by a range split of
    the order (`ordered_position`), which deals every source to many tasks.
    """
    if isinstance(max_items, bool) or not isinstance(max_items, int) or max_items <= 0:
        raise ValueError(f"max_items must be a positive number, not {max_items!r}")
    if max_items <= WINDOW_ROWS:
        return first_rows(df, list(source), order, max_items)
    named = {f"_order_{n}": F.col(c) if isinstance(c, str) else c for n, c in enumerate(order)}
    placed = ordered_position(df.withColumns(named), list(source), [], list(named), "_place").where(F.col("_place") <= max_items)
    # Rows that are equal in the order have one place; they are told apart here.
    equal = F.row_number().over(Window.partitionBy(*source, "_place").orderBy(*named)) - 1
    return placed.withColumn("_equal", equal).where(F.col("_place") + F.col("_equal") <= max_items).drop("_place", "_equal", *named)
