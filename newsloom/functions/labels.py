"""Tier, sentiment and category labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.cells import lookup
from newsloom.functions.text import clean_value, contains_any, fold, fold_text, let, strip, text


def tier_order(tier: Column) -> Column:
    """The first run of digits as a number; tiers without one come last."""
    return F.coalesce(F.regexp_extract(text(tier), r"(\d+)", 1).try_cast("double"), F.lit(float(d.TIER_UNKNOWN)))


def sentiment_bucket(sentiment: Column) -> Column:
    label = F.upper(clean_value(sentiment))
    positive = F.contains(label, F.lit("POSITIVO"))
    return (
        F.when(positive & F.contains(label, F.lit("PROACTIVO")), d.PROACTIVE)
        .when(positive, d.POSITIVE)
        .when(F.contains(label, F.lit("NEGATIVO")), d.NEGATIVE)
        .otherwise(d.NEUTRAL)
    )


def sentiment_rank(bucket: Column) -> Column:
    """Display rank of a bucket, 0 first."""
    order = reduce(lambda case, item: case.when(bucket == item[1], item[0]), enumerate(d.SENTIMENT_ORDER), F)
    return order


def sentiment_color(sentiment: Column) -> Column:
    label = F.upper(text(sentiment))
    return (
        F.when(F.contains(label, F.lit("POSITIVO")), d.COLOR_POSITIVE)
        .when(F.contains(label, F.lit("NEGATIVO")), d.COLOR_NEGATIVE)
        .otherwise(d.COLOR_NEUTRAL)
    )


def validate_sentiment(raw: Column) -> Column:
    """A raw answer that is exactly one of the three labels, else neutral."""
    answer = F.upper(clean_value(raw))
    return F.when(answer.isin(d.POSITIVE, d.NEGATIVE, d.NEUTRAL), answer).otherwise(d.NEUTRAL)


def category_by_rules(
    folded: Column,
    terms: Mapping[str, Sequence[str]] = d.CATEGORY_TERMS,
    priority: Sequence[str] = d.CATEGORY_PRIORITY,
) -> Column:
    """The first category, by priority, with a term in the folded text; NULL when none has."""
    return let(folded, lambda t: reduce(lambda case, name: case.when(contains_any(t, terms[name]), name), priority, F))


def category_from_label_fuzzy(
    raw: Column,
    aliases: Mapping[str, str] = d.LABEL_ALIASES,
    default: str = d.OWN_DEFAULT_CATEGORY,
) -> Column:
    """The category of the first alias contained in a raw label, in alias order."""
    label = F.regexp_replace(F.upper(clean_value(raw)), r"[\"'.,]", " ")

    def first_alias(t: Column) -> Column:
        found = reduce(lambda case, item: case.when(F.contains(t, F.lit(item[0])), item[1]), aliases.items(), F)
        return found.otherwise(default)

    return let(label, first_alias)


def category_from_label_strict(
    raw: Column,
    categories: Sequence[str] = d.CATEGORIES,
    terms: Mapping[str, Sequence[str]] = d.CATEGORY_TERMS,
    default: str = d.CLIPPING_DEFAULT_CATEGORY,
) -> Column:
    """The category that equals the folded label, else the first one (in listed order) with a term in it."""
    names = {fold_text(name): name for name in categories}

    def category(t: Column) -> Column:
        equal = lookup(names, t, F.lit(None).cast("string"))
        return F.coalesce(equal, category_by_rules(t, terms, categories), F.lit(default))

    return let(fold(raw), category)


def is_refusal_own(raw: Column) -> Column:
    answer = clean_value(raw)
    return (answer == "") | answer.startswith("(") | F.contains(F.lower(answer), F.lit(d.REFUSAL_WORD))


def is_refusal_clipping(raw: Column) -> Column:
    answer = clean_value(raw)
    lowered = F.lower(answer)
    return (
        answer.startswith("(")
        | lowered.startswith(d.REFUSAL_OPENING)
        | F.contains(lowered, F.lit(d.REFUSAL_PHRASE))
    )


def build_prompt(body: Column, template: str, limit: int | None = None) -> Column:
    """The trimmed text inside a template with a `{text}` mark; whole unless the caller sets a limit."""
    before, after = template.split("{text}")
    whole = strip(text(body))
    return F.concat(F.lit(before), whole if limit is None else F.substring(whole, 1, limit), F.lit(after))


def prompt_parts(body: Column, template: str, limit: int) -> Column:
    """Prompts that together hold the whole text, each with at most `limit` characters of it; one for an empty text."""
    before, after = template.split("{text}")

    def cut(whole: Column) -> Column:
        last = F.greatest(F.ceil(F.length(whole) / limit).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), last), lambda n: F.concat(F.lit(before), F.substring(whole, (n - 1) * limit + 1, F.lit(limit)), F.lit(after)))

    return let(strip(text(body)), cut)
