"""From feed items to new table rows, as one job with three parameter sets.

The order of the steps carries meaning: links are deduplicated before the date filter, so an older
copy of an item may win and then drop.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.dates import ZONE, format_scraped_at, local_date_text, parse_utc, to_local
from newsloom.functions.links import normalize_link_suffix, strip_query_fragment, url_key
from newsloom.functions.text import text
from newsloom.operators.columns import conform, ensure_columns, map_country, sanitize_cells
from newsloom.operators.dedupe import content_hash, first_rows
from newsloom.operators.filters import has_key, mentions_brand, recent_days
from newsloom.operators.joins import only_new, resolve_links
from newsloom.session import ROW_ID, stage, with_row_ids
from newsloom.sources.tables import append_new, read_target, stored_names

LinkRule = Callable[[Column], Column]


@dataclass(frozen=True)
class FeedConfig:
    """What sets one feed apart.

    The four link rules apply one after the other: to the link as read, to the link after
    redirects are resolved, to the link that is stored, and to the stored link for its key.
    """

    header: Sequence[str]
    read_link: LinkRule
    resolved_link: LinkRule
    stored_link: LinkRule
    key: LinkRule
    countries: Mapping[str, str] = field(default_factory=lambda: d.COUNTRY_NAMES)
    pattern: str | None = None
    recent_only: bool = True
    content_dedupe: bool = True
    drop_words: bool = True
    zone: str = ZONE


OWN_FEED = FeedConfig(
    header=d.OWN_HEADER,
    read_link=normalize_link_suffix,
    resolved_link=normalize_link_suffix,
    stored_link=normalize_link_suffix,
    key=normalize_link_suffix,
    pattern=d.OWN_PATTERN,
)
CLIPPING_FEED = FeedConfig(
    header=d.CLIPPING_HEADER,
    read_link=text,
    resolved_link=text,
    stored_link=text,
    key=url_key,
    countries=d.CLIPPING_COUNTRY_NAMES,
)
COMPETITOR_FEED = FeedConfig(
    header=d.COMPETITOR_HEADER,
    read_link=strip_query_fragment,
    resolved_link=text,
    stored_link=text,
    key=strip_query_fragment,
    pattern=d.COMPETITOR_PATTERN,
    recent_only=False,
    content_dedupe=False,
    drop_words=False,
)

FIELDS = ("link", "title", "snippet", "domain", "source", "date_utc", "country", "scraped_at", "tag")


def clean_feed(
    feed: DataFrame,
    config: FeedConfig,
    today: date,
    order: Sequence[str],
    resolved: DataFrame | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """Feed items as table rows in header order, plus `link_key`.

    `order` names the columns that decide which copy of an item comes first. Their values are kept
    apart from the start, so header columns may be named although the table shows them otherwise.
    `resolved` holds the targets of redirects. `refine` runs on the recent rows, before the table layout: body and
    category joins of the clipping feed go there.
    `texts` holds the feed's long columns in a table of their own, by the columns that both have; items without a row
    there are left out. Then the copies are told apart by the narrow items alone, and only what the rows that are left
    need is fetched; a feed that many items share its texts with should be given so.
    """
    link = F.col("link")
    kept = {f"_order_{n}": F.col(name) for n, name in enumerate(order)}
    order = list(kept)
    by = [] if texts is None else [c for c in texts.columns if c in feed.columns]
    later = [] if texts is None else texts.columns
    items = ensure_columns(feed, [c for c in FIELDS if c not in later]).withColumns(kept).withColumn("link", config.read_link(link))
    if resolved is not None:
        items = resolve_links(items, resolved)
    day = F.to_date(to_local(parse_utc(F.col("date_utc")), config.zone))
    items = items.withColumns({"link": config.resolved_link(link), "published_day": day})
    if texts is None:
        staged = with_row_ids(items)
        firsts = first_rows(staged.select(ROW_ID, "link", "published_day", *order), ["link"], order)
    else:
        firsts = first_rows(items.join(texts.select(*by), by, "left_semi"), ["link"], order)
    if config.recent_only:
        firsts = recent_days(firsts, today)
    if texts is None:
        items = staged.join(firsts.select(ROW_ID), ROW_ID, "left_semi").drop(ROW_ID)
    else:
        items = firsts.join(texts.hint("merge"), by)
        if refine:
            # A link whose texts are there several times is one item still; without a refinement the steps below see to it.
            staged = with_row_ids(items)
            one = first_rows(staged.select(ROW_ID, "link"), ["link"], [ROW_ID])
            items = staged.join(one.select(ROW_ID), ROW_ID, "left_semi").drop(ROW_ID)
    items = items.withColumns(
        {
            "date_utc": local_date_text(F.col("date_utc"), config.zone),
            "country": map_country(F.col("country"), config.countries),
            "scraped_at": format_scraped_at(F.col("scraped_at")),
        }
    )
    if config.pattern:
        items = mentions_brand(items, config.pattern)
    if refine:
        items = refine(items)
    rows = conform(items, [*config.header, *order]).withColumn("link", config.stored_link(link)).withColumn("link_key", config.key(link))
    staged = with_row_ids(rows.withColumn("_content", content_hash(["title", "snippet"])))
    left = staged.select(ROW_ID, "link", "link_key", "_content", *order)
    if config.content_dedupe:
        left = first_rows(first_rows(left, ["link"], order), ["_content"], order)
    left = first_rows(has_key(left), ["link_key"], order)
    return staged.join(left.select(ROW_ID), ROW_ID, "left_semi").drop(ROW_ID, "_content", *order)


def new_rows(clean: DataFrame, target: DataFrame, config: FeedConfig, narrow: bool = False) -> DataFrame:
    """The clean rows whose key the target lacks, as table text."""
    fresh = only_new(clean, target, narrow=narrow)
    return sanitize_cells(fresh.select(*config.header, "link_key"), config.drop_words)


def ingest(
    feed: DataFrame,
    target_path: str,
    config: FeedConfig,
    today: date,
    order: Sequence[str],
    resolved: DataFrame | None = None,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    since: date | None = None,
    max_records: int | None = None,
    buckets: int | None = None,
    texts: DataFrame | None = None,
) -> None:
    """Append the new rows of a feed. Running it again on the same feed adds nothing.

    With `buckets` the target is laid out by the hash of its keys and a batch reads its own parts only.
    A table kept under a header of its own, such as an older sheet, keeps it: its columns are found by
    name, in any case, or by position, its links are brought into canonical form to be compared, and new
    rows are added under its names. `texts` may hold the feed's long columns (`clean_feed`).

    The clean batch is checkpointed, as it is compared with the target and then written; set
    `spark.checkpoint.dir` to a folder that all executors share.
    """
    spark = feed.sparkSession
    clean = clean_feed(feed, config, today, order, resolved, refine, texts).transform(stage)
    names = stored_names(spark, target_path, config.header)
    target = read_target(spark, target_path, config.header, since=since, buckets=buckets, batch=clean, names=names)
    # A table kept without keys gets them from its links, brought into canonical form once more.
    known = target.withColumn("link_key", F.coalesce(F.col("link_key"), config.key(config.stored_link(F.col("link")))))
    append_new(new_rows(clean, known, config, narrow=True), target_path, config.header, today, max_records=max_records, buckets=buckets, names=names)
