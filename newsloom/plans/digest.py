"""Digests from the own and competitor tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_scraped_at, window_bounds
from newsloom.operators.digest import (
    block_label,
    block_rank,
    card_fields,
    card_html,
    card_text,
    digest_cards,
    digest_document,
    digest_rows,
    digest_subject,
    union_blocks,
    with_digest_day,
)
from newsloom.operators.filters import digest_window


def table_rows(table: DataFrame) -> DataFrame:
    """Table text as digest input: the shown stamp becomes the local time the windows run on.

    Rows of the same minute keep the order of their `seq`; tables without one go by link.
    """
    stamped = table.withColumn("scraped_ts", parse_scraped_at(F.col("scraped_at")))
    return stamped if "seq" in table.columns else stamped.withColumn("seq", F.col("link"))


def digest_input(own: DataFrame, competitor: DataFrame) -> DataFrame:
    """The flagged rows of both tables with their digest day, for every digest in the tables."""
    return with_digest_day(union_blocks(own, competitor))


def cards(own: DataFrame, competitor: DataFrame, now: datetime | None = None, markup: bool = False) -> DataFrame:
    """The card fields of all digests, or of the one that closes on the day of `now`; with `markup` for `card_html`.

    Both tables need `scraped_ts` and `seq`; a window on `now` prunes their scans.
    """
    if now is None:
        rows = digest_input(own, competitor)
    else:
        # The digest is that of the day of `now`, weekends included; only the set form waits for Monday.
        blocks = union_blocks(digest_window(own, now), digest_window(competitor, now))
        rows = blocks.withColumn("digest_day", F.lit(window_bounds(now).end.date()))
    return card_fields(digest_cards(digest_rows(rows), markup=markup))


def documents(fields: DataFrame, html: bool = False, cards_per_part: int = 200, own_name: str = "Own") -> DataFrame:
    """Digest texts per (digest day, block, country) in numbered parts, with their subject and the rank of their block.

    `html` needs cards made with `markup`. A day's parts by (`block_rank`, country, part) are its mail.
    """
    label = block_label(F.col("block"), F.col("country"), own_name)
    heading = F.concat(F.lit("<h2>"), label, F.lit("</h2>")) if html else F.concat(label, F.lit("\n\n"))
    body = card_html(fields) if html else card_text(fields)
    return digest_document(fields, body, heading, cards_per_part=cards_per_part).withColumns(
        {"subject": digest_subject(F.col("digest_day")), "block_rank": block_rank(F.col("block"))}
    )
