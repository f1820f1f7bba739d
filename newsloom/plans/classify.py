"""Category and sentiment: cache first, then rules, then a labeller for what is left."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.html import paragraph_text
from newsloom.functions.labels import (
    build_prompt,
    category_by_rules,
    category_from_label_fuzzy,
    category_from_label_strict,
    is_refusal_clipping,
    is_refusal_own,
    validate_sentiment,
)
from newsloom.functions.text import combine_text, fold, strip, text
from newsloom.operators.joins import hot_keys, one_per_key, with_lookup

Labeller = Callable[[DataFrame], DataFrame]
Batches = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def stored_labeller(responses: DataFrame) -> Labeller:
    """Raw answers from a table (key, raw), of several answers to a key one."""
    one = one_per_key(responses, "key", "raw")
    # Answers are computed texts, whose size Spark underestimates: never broadcast them on that ground.
    return lambda asks: asks.join(one.hint("merge"), "key", "left").select("key", "raw")


def batch_labeller(ask: Batches) -> Labeller:
    """Raw answers from a function over Arrow batches of (key, prompt), such as a model client."""
    return lambda asks: asks.select("key", "prompt").mapInPandas(ask, "key string, raw string")


def own_category(raw: Column) -> Column:
    """A raw answer of the own feed's labeller as a category."""
    return F.when(is_refusal_own(raw), d.OWN_DEFAULT_CATEGORY).otherwise(category_from_label_fuzzy(raw))


def clipping_category(raw: Column) -> Column:
    """A raw answer of the clipping feed's labeller as a category."""
    return F.when(is_refusal_clipping(raw), d.CLIPPING_DEFAULT_CATEGORY).otherwise(category_from_label_strict(raw))


def classify(
    df: DataFrame,
    cache: DataFrame,
    labeller: Labeller,
    template: str | None = None,
    rules: Callable[[Column], Column] = category_by_rules,
    to_category: Callable[[Column], Column] = clipping_category,
    key: str = "url_key",
    order: Sequence[str] = (),
) -> DataFrame:
    """Add `tag` and `tag_origin` (cache, rules, labeller); the number of rows never changes.

    Only rows without a cache entry and without a rule reach the labeller, once per key: with the text
    of the first such row in `order`, or the first by text. Rows with an empty key use neither the cache
    nor the labeller's key and get the rule or the default. `new_labels` gives what the cache lacks.
    """
    template = template or d.category_prompt()
    entries = one_per_key(cache.where(F.col("key") != ""), "key", "value").select(F.col("key").alias(key), F.col("value").alias("_cached"))
    combined = combine_text(*[strip(text(F.col(c))) for c in ("title", "snippet", "article_body")])
    hot = hot_keys(df, key)
    known = with_lookup(df, entries, key, "_cached", hot=hot).withColumn("_text", combined)
    ruled = known.withColumn("_rule", F.when(F.col("_cached").isNull(), rules(fold(F.col("_text")))))
    open_rows = ruled.where(F.col("_cached").isNull() & F.col("_rule").isNull() & (F.col(key) != ""))
    asks = open_rows.groupBy(F.col(key).alias("key")).agg(F.min_by("_text", F.struct(*order, "_text")).alias("_text"))
    answers = labeller(asks.select("key", build_prompt(F.col("_text"), template).alias("prompt")))
    labelled = one_per_key(answers, "key", "raw").select(F.col("key").alias(key), to_category(F.col("raw")).alias("_label"))
    tagged = with_lookup(ruled, labelled, key, "_label", hot=hot)
    origin = F.when(F.col("_cached").isNotNull(), "cache").when(F.col("_rule").isNotNull(), "rules").otherwise("labeller")
    return tagged.withColumns(
        {"tag": F.coalesce("_cached", "_rule", "_label", to_category(F.lit(""))), "tag_origin": origin}
    ).drop("_cached", "_rule", "_label", "_text")


def new_labels(tagged: DataFrame, key: str = "url_key") -> DataFrame:
    """What `classify` found by rules or labeller, one (key, value) row per key, to be saved in the cache.

    A rule's label goes before a labeller's where rows of one key got both.
    """
    found = tagged.where((F.col("tag_origin") != "cache") & (F.col(key) != ""))
    return found.groupBy(F.col(key).alias("key")).agg(F.max_by("tag", F.struct("tag_origin", "tag")).alias("value"))


def classify_sentiment(pages: DataFrame, labeller: Labeller, subject: str, key: str = "url", html: str = "html") -> DataFrame:
    """Sentiment per page from its paragraphs; pages without text or answer are neutral."""
    before, after = d.sentiment_prompt(subject).split("{text}")
    bodies = one_per_key(pages.select(F.col(key).alias("key"), paragraph_text(F.col(html)).alias("_text")), "key", "_text")
    prompt = F.concat(F.lit(before), F.col("_text"), F.lit(after))
    answers = labeller(bodies.where(F.col("_text") != "").select("key", prompt.alias("prompt")))
    labels = one_per_key(answers, "key", "raw").select(F.col("key").alias(key), F.col("raw"))
    return (
        pages.drop(html)
        .join(labels, key, "left")
        .withColumn("sentiment", validate_sentiment(F.col("raw")))
        .drop("raw")
    )
