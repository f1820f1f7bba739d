"""Digests: ranking inside topics, secondary coverage, display order, cards and documents.

Every operator works on all digest days of its input at once. A digest row has the columns
`digest_day, block, country`, the news columns of the table headers and `scraped_ts, seq`, where
`(scraped_ts, seq)` is the input order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.dates import digest_day, digest_label
from newsloom.functions.labels import sentiment_bucket, sentiment_rank, tier_order
from newsloom.functions.text import clean_value, first_non_empty, text
from newsloom.operators.columns import country_flag, ensure_columns
from newsloom.operators.filters import flagged, has_topic
from newsloom.operators.ranking import ordered_position

OWN, COMPETITOR = "own", "competitor"
SECTION = ["digest_day", "block", "country"]
TOPIC = [*SECTION, "sent_rank", "tema"]
INPUT_ORDER = ["scraped_ts", "seq"]


def union_blocks(own: DataFrame, competitor: DataFrame) -> DataFrame:
    """The flagged rows of the own table and of the competitor table, each as its block.

    The flag is a matter of each table: one without the column takes part whole.
    """
    return (
        flagged(own)
        .withColumn("block", F.lit(OWN))
        .unionByName(flagged(competitor).withColumn("block", F.lit(COMPETITOR)), allowMissingColumns=True)
    )


def with_digest_day(df: DataFrame, stamp: str = "scraped_ts") -> DataFrame:
    """The digest that carries each row; rows without a readable stamp belong to none."""
    return df.where(F.col(stamp).isNotNull()).withColumn("digest_day", digest_day(F.col(stamp)))


def digest_rows(df: DataFrame) -> DataFrame:
    """Digest rows with the columns that order them; the editorial flag has been applied per table.

    Rows without a country drop; the competitor block is shown as neutral throughout.
    """
    ready = ensure_columns(df, ["tema", "tier", "prioridad", "sentiment", "tag", "domain", "source", "title", "snippet", "link"])
    ready = ready.where(F.col("country").isNotNull())
    bucket = F.when(F.col("block") == COMPETITOR, d.NEUTRAL).otherwise(sentiment_bucket(F.col("sentiment")))
    return (
        ready.withColumn("sentiment_norm", bucket)
        .withColumn("sent_rank", sentiment_rank(F.col("sentiment_norm")).cast("bigint"))
        .withColumns(
            {
                "tema": text(F.col("tema")),
                "tier_order": tier_order(F.col("tier")),
                "tier_label": clean_value(F.col("tier")),
                "prio_rank": F.when(clean_value(F.col("prioridad")) != "", 0).otherwise(1).cast("bigint"),
                "has_topic": has_topic(F.col("tema")),
            }
        )
    )


def topic_best_tier(rows: DataFrame) -> DataFrame:
    """The lowest tier number of each topic."""
    return rows.where("has_topic").groupBy(*TOPIC).agg(F.min("tier_order").alias("best_tier"))


def rank_in_topic(rows: DataFrame) -> DataFrame:
    """Rank inside each topic: priority first, then tier, then input order."""
    return ordered_position(rows.where("has_topic"), TOPIC, ["prio_rank", "tier_order"], INPUT_ORDER, "rank")


def topic_leaders(rows: DataFrame, per_tier: int = d.ALSO_IN_PER_TIER) -> DataFrame:
    """The rows a topic shows: its principal and the first `per_tier` secondaries of each tier.

    One row more than `per_tier` per (topic, tier) is kept before and after the shuffle, as the
    principal is the first of its own tier. Whatever a topic shows comes from these rows, however
    many rows it has. Adds `is_principal`, `secondary_rank` and `best_tier`.
    """
    order = ["prio_rank", "tier_order", *INPUT_ORDER]
    per_label = Window.partitionBy(*TOPIC, "tier_label").orderBy(*order)
    kept = (
        rows.where("has_topic")
        .withColumn("_in_tier", F.row_number().over(per_label))
        .where(F.col("_in_tier") <= per_tier + 1)
    )
    topic = Window.partitionBy(*TOPIC)
    ranked = kept.withColumns(
        {
            "is_principal": F.row_number().over(topic.orderBy(*order)) == 1,
            "_lead": F.first("tier_label").over(topic.orderBy(*order)),
            "best_tier": F.min("tier_order").over(topic),
        }
    )
    secondary = F.col("_in_tier") - F.when(F.col("tier_label") == F.col("_lead"), 1).otherwise(0)
    return (
        ranked.withColumn("secondary_rank", F.when(~F.col("is_principal"), secondary).cast("bigint"))
        .where(F.col("is_principal") | (F.col("secondary_rank") <= per_tier))
        .drop("_in_tier", "_lead")
    )


def mention(source: Column, link: Column) -> Column:
    """A secondary item: its medium, with the link where there is one."""
    return F.when(clean_value(link) != "", F.format_string("%s <%s>", clean_value(source), clean_value(link))).otherwise(
        clean_value(source)
    )


def mention_html(source: Column, link: Column) -> Column:
    """A secondary item as markup: its medium as a link where there is one, all values escaped."""
    shown, target = escape_html(clean_value(source)), clean_value(link)
    return F.when(target != "", F.concat(F.lit('<a href="'), escape_html(target), F.lit('">'), shown, F.lit("</a>"))).otherwise(shown)


def also_in(leaders: DataFrame, shown: Callable[[Column, Column], Column] = mention) -> DataFrame:
    """One row per topic and tier with the tier's secondaries in rank order, each `shown` by its source and link."""
    items = F.expr("listagg(_mention, ' | ') WITHIN GROUP (ORDER BY secondary_rank)")
    return (
        leaders.where(~F.col("is_principal"))
        .withColumn("_mention", shown(F.col("source"), F.col("link")))
        .groupBy(*TOPIC, "tier_label")
        .agg(items.alias("items"))
    )


def topic_cards(leaders: DataFrame, markup: bool = False) -> DataFrame:
    """One card per topic: the principal with its list of further media, as text or as markup with links."""
    tiers = also_in(leaders, mention_html if markup else mention)
    label = F.concat(F.lit("<b>"), escape_html(F.col("tier_label")), F.lit(":</b> ")) if markup else F.concat("tier_label", F.lit(": "))
    between = "<br>" if markup else "\n"
    lists = tiers.withColumn("_line", F.concat(label, "items")).groupBy(*TOPIC).agg(
        F.expr(f"listagg(_line, '{between}') WITHIN GROUP (ORDER BY tier_label)").alias("also_in")
    )
    principals = leaders.where("is_principal").drop("is_principal", "secondary_rank")
    # Both sides are distributed by topic already, so a merge join moves nothing.
    return principals.join(lists.hint("merge"), TOPIC, "left").withColumn("also_in", text(F.col("also_in")))


def digest_cards(
    rows: DataFrame, per_tier: int = d.ALSO_IN_PER_TIER, markup: bool = False, texts: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """All cards of all digests with their `position` inside (digest day, block, country).

    With `markup`, `also_in` is escaped markup with links, for `card_html`; else it is text.

    Sentiments follow their fixed order; inside one, topics come first, by best tier and name,
    then the rows without a topic by tier and input order. (`scraped_ts`, `seq`) tells the rows of a section apart.
    `texts` holds columns that order nothing, such as title and snippet, once for every value of the columns `by`, which
    the rows have, too. They are joined to the cards when these have their places, so they move once.
    """
    if texts is not None:
        rows = rows.drop(*[c for c in texts.columns if c not in by])
    topics = topic_cards(topic_leaders(rows, per_tier), markup).withColumns(
        {"section": F.lit(0).cast("bigint"), "card_tier": F.col("best_tier"), "card_topic": F.col("tema")}
    )
    singles = rows.where(~F.col("has_topic")).withColumns(
        {"also_in": F.lit(""), "section": F.lit(1).cast("bigint"), "card_tier": F.col("tier_order"), "card_topic": F.lit("")}
    )
    cards = topics.drop("best_tier").unionByName(singles)
    lead = ["sent_rank", "section", "card_tier", "card_topic"]
    placed = ordered_position(cards, SECTION, lead, INPUT_ORDER, "position").drop("card_topic")
    return placed if texts is None else placed.join(texts.hint("merge"), list(by))


def card_fields(cards: DataFrame) -> DataFrame:
    """The displayed fields of each card; the competitor block hides its sentiment."""
    shown = F.when(F.col("block") == COMPETITOR, "").otherwise(F.upper(clean_value(F.col("sentiment"))))
    return cards.select(
        *SECTION,
        "position",
        F.upper(clean_value(F.col("tag"))).alias("tag"),
        clean_value(F.col("title")).alias("title"),
        clean_value(F.col("snippet")).alias("snippet"),
        clean_value(first_non_empty(F.col("source"), F.col("domain"))).alias("media"),
        F.col("tier_label").alias("tier"),
        clean_value(F.col("link")).alias("link"),
        shown.alias("sentiment"),
        "also_in",
    )


def card_text(fields: DataFrame, also_in_title: str = d.CARD_ALSO_IN) -> Column:
    """A card as plain text, one field per line."""
    return F.concat(
        F.concat_ws(
            "\n",
            F.col("tag"),
            F.col("title"),
            F.col("snippet"),
            F.concat(F.lit(d.CARD_MEDIA), F.col("media"), F.lit(" | "), F.col("tier")),
            F.col("link"),
            F.when(F.col("block") != COMPETITOR, F.concat(F.lit(d.CARD_SENTIMENT), F.col("sentiment"))),
            F.when(F.col("also_in") != "", F.concat(F.lit(also_in_title + "\n"), F.col("also_in"))),
        ),
        F.lit("\n\n"),
    )


def escape_html(col: Column) -> Column:
    for char, entity in {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}.items():
        col = F.replace(col, F.lit(char), F.lit(entity))
    return col


def card_html(fields: DataFrame, also_in_title: str = d.CARD_ALSO_IN) -> Column:
    """A card as unstyled markup with escaped values; `also_in` is markup already (`digest_cards`)."""
    e = {name: escape_html(F.col(name)) for name in ("tag", "title", "snippet", "media", "tier", "link", "sentiment")}
    parts = F.concat_ws(
        "",
        F.concat(F.lit("<article><b>"), e["tag"], F.lit("</b>")),
        F.concat(F.lit('<h3><a href="'), e["link"], F.lit('">'), e["title"], F.lit("</a></h3>")),
        F.concat(F.lit("<p>"), e["snippet"], F.lit("</p>")),
        F.concat(F.lit(f"<p>{d.CARD_MEDIA}"), e["media"], F.lit(" | "), e["tier"], F.lit("</p>")),
        F.when(F.col("block") != COMPETITOR, F.concat(F.lit(f"<p>{d.CARD_SENTIMENT}"), e["sentiment"], F.lit("</p>"))),
        F.when(F.col("also_in") != "", F.concat(F.lit(f"<p>{also_in_title}<br>"), F.col("also_in"), F.lit("</p>"))),
    )
    return F.concat(parts, F.lit("</article>"))


def block_label(block: Column, country: Column, own_name: str = "Own", competitor_name: str = d.COMPETITOR_NAME) -> Column:
    name = F.when(block == COMPETITOR, competitor_name).otherwise(own_name)
    return F.concat(name, F.lit(" — "), country, F.lit(" "), country_flag(country))


def block_rank(block: Column) -> Column:
    """The place of a block in the mail: the own one comes first."""
    return F.when(block == COMPETITOR, 1).otherwise(0)


def digest_subject(day: Column, name: str = "Newsletter") -> Column:
    return F.concat(F.lit(f"{name} ("), digest_label(day), F.lit(")"))


def digest_document(
    fields: DataFrame, body: Column, heading: Column, group: Sequence[str] = tuple(SECTION), cards_per_part: int = 200
) -> DataFrame:
    """The digest text per group, in numbered parts of at most `cards_per_part` cards.

    The parts of a group, joined in order, are its document; the first one opens with the
    heading. A digest of any size is written without gathering it in one row. Parts in the order of
    (digest day, `block_rank` of the block, country, part) are the whole digest.
    """
    part = F.floor((F.col("position") - 1) / F.lit(cards_per_part)).cast("bigint") + 1
    cards = fields.withColumns({"part": part, "_heading": heading, "_body": body}).select(
        *group, "part", "position", "_body", F.when(F.col("position") == 1, F.col("_heading")).otherwise("").alias("_heading")
    )
    joined = F.expr("listagg(concat(_heading, _body), '') WITHIN GROUP (ORDER BY position)")
    return cards.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("cards"), joined.alias("document"))


def plain_items(df: DataFrame) -> Column:
    """A list entry of the plain digest: title and medium, then the link."""
    media = clean_value(first_non_empty(F.col("source"), F.col("domain")))
    return F.concat(
        F.lit("- "), clean_value(F.col("title")), F.lit(" ("), media, F.lit(")\n  "), clean_value(F.col("link")), F.lit("\n")
    )


def plain_digest(df: DataFrame, cards_per_part: int = 200) -> DataFrame:
    """The plain list per (slot date, slot, country), in numbered parts and in input order."""
    group = ["slot_date", "slot", "country"]
    items = df.where(F.col("country").isNotNull() & F.col("slot").isNotNull())
    placed = ordered_position(items, group, [], INPUT_ORDER, "position")
    heading = F.concat(F.lit("=== "), F.col("country"), F.lit(" ===\n"))
    return digest_document(placed, plain_items(placed), heading, group, cards_per_part)
