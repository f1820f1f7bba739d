"""Whole jobs: from feed items to labelled rows in a table, with the cache that the next run uses."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.labels import category_by_rules, validate_sentiment
from newsloom.functions.links import url_key
from newsloom.operators.filters import relevance
from newsloom.operators.joins import attach_body, one_per_key, with_lookup
from newsloom.operators.metrics import category_distribution
from newsloom.plans.classify import Labeller, classify, new_labels, own_category
from newsloom.plans.ingest import CLIPPING_FEED, OWN_FEED, FeedConfig, ingest
from newsloom.session import stage
from newsloom.sources.lookups import load_lookup, save_lookup
from newsloom.sources.tables import INGEST_DAY, read_target


def _remembered(tagged: DataFrame, cache_path: str) -> DataFrame:
    """The tagged rows, staged, after what they add to the cache has been saved; saving it again changes nothing."""
    tagged = stage(tagged)
    save_lookup(new_labels(tagged), cache_path)
    return tagged


def _distribution(spark, path: str, config: FeedConfig, today: date) -> DataFrame:
    """Rows per tag of what was added on a day."""
    return category_distribution(read_target(spark, path, config.header, since=today).where(F.col(INGEST_DAY) == F.lit(today)))


def own_job(
    feed: DataFrame,
    target_path: str,
    cache_path: str,
    labeller: Labeller,
    sentiments: DataFrame,
    today: date,
    order: Sequence[str],
    config: FeedConfig = OWN_FEED,
    texts: DataFrame | None = None,
) -> DataFrame:
    """The own feed into its table with category and sentiment; gives the day's distribution of tags.

    Categories come from the cache, else from the labeller, whose answers are matched loosely; no rules.
    `sentiments` (key, raw) holds the answers by canonical link; rows without one are neutral. `texts` may hold the
    feed's long columns (`clean_feed`).
    """
    spark = feed.sparkSession

    def label(rows: DataFrame) -> DataFrame:
        keyed = rows.drop("tag", "sentiment").withColumns({"url_key": F.col("link"), "article_body": F.lit("")})
        none = lambda _folded: F.lit(None).cast("string")
        tagged = classify(keyed, load_lookup(spark, cache_path), labeller, rules=none, to_category=own_category)
        answers = one_per_key(sentiments, "key", "raw").select(F.col("key").alias("url_key"), F.col("raw").alias("_raw"))
        judged = with_lookup(_remembered(tagged, cache_path), answers, "url_key", "_raw")
        return judged.withColumn("sentiment", validate_sentiment(F.col("_raw"))).drop("_raw")

    ingest(feed, target_path, config, today, order, refine=label, texts=texts)
    return _distribution(spark, target_path, config, today)


def clipping_job(
    feed: DataFrame,
    target_path: str,
    cache_path: str,
    bodies: DataFrame,
    labeller: Labeller,
    today: date,
    order: Sequence[str],
    include: Iterable[str] = d.INCLUDE_TERMS,
    exclude: Iterable[str] = d.EXCLUDE_TERMS,
    rules: Callable[[Column], Column] = category_by_rules,
    config: FeedConfig = CLIPPING_FEED,
    texts: DataFrame | None = None,
) -> DataFrame:
    """The clipping feed into its table: bodies (url_key, article_body), relevance, category; gives the day's distribution.

    Categories come from the cache, the rules or the labeller, in this order, and are saved in the cache. `texts` may
    hold the feed's long columns (`clean_feed`).
    """
    spark = feed.sparkSession

    def label(rows: DataFrame) -> DataFrame:
        bodied = attach_body(rows.drop("tag").withColumn("url_key", url_key(F.col("link"))), bodies)
        found = relevance(bodied, include, exclude)
        return _remembered(classify(found, load_lookup(spark, cache_path), labeller, rules=rules), cache_path)

    ingest(feed, target_path, config, today, order, refine=label, texts=texts)
    return _distribution(spark, target_path, config, today)
