"""Digests over every digest day of the item feed."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import dates
from newsloom.operators import digest
from newsloom.operators.columns import map_country
from newsloom.operators.dedupe import content_hash
from newsloom.operators.filters import flagged
from newsloom.plans.digest import cards, documents, table_rows
from newsloom.session import written
from newsloom.workload.cleaning import SENTIMENT_BUCKET_SQL
from newsloom.workload.registry import query
from newsloom.workload.views import COUNTRY_NAME_SQL, ITEMS_SQL, item_log, item_texts, items, with_documents, with_views

DIGEST_DAY_SQL = """CAST(scraped_ts + INTERVAL 15 HOUR AS DATE) + CAST(CASE isodow(scraped_ts + INTERVAL 15 HOUR)
  WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS INTEGER)"""

ROWS_SQL = f"""
digest_rows AS (
  SELECT *, CASE bucket WHEN 'POSITIVO (PROACTIVO)' THEN 0 WHEN 'POSITIVO' THEN 1 WHEN 'NEGATIVO' THEN 2 ELSE 3 END
    AS sent_rank
  FROM (
    SELECT * REPLACE ({COUNTRY_NAME_SQL} AS country), {DIGEST_DAY_SQL} AS digest_day,
      CASE WHEN block = 'competitor' THEN 'NEUTRO' ELSE {SENTIMENT_BUCKET_SQL} END AS bucket,
      CAST(coalesce(TRY_CAST(regexp_extract(coalesce(tier, ''), '([0-9]+)', 1) AS DOUBLE), 99) AS DOUBLE) AS tier_order,
      trim(coalesce(tier, '')) AS tier_label,
      CASE WHEN trim(coalesce(prioridad, '')) <> '' THEN 0 ELSE 1 END AS prio_rank
    FROM items WHERE event_type IN ('view', 'click', 'purchase') AND country IS NOT NULL)
)
"""

RANKED_SQL = """
ranked AS (
  SELECT *, row_number() OVER topic AS rank, min(tier_order) OVER (PARTITION BY digest_day, block, country, sent_rank, tema)
    AS best_tier
  FROM digest_rows WHERE tema <> ''
  WINDOW topic AS (PARTITION BY digest_day, block, country, sent_rank, tema
    ORDER BY prio_rank, tier_order, scraped_ts, seq)
)
"""

SECONDARY_SQL = """
secondary AS (
  SELECT *, row_number() OVER (PARTITION BY digest_day, block, country, sent_rank, tema, tier_label ORDER BY rank) AS n,
    CASE WHEN trim(coalesce(link, '')) <> '' THEN source || ' <' || trim(link) || '>' ELSE source END AS mention
  FROM ranked WHERE rank > 1
),
mentions AS (
  SELECT digest_day, block, country, sent_rank, tema, tier_label, string_agg(mention, ' | ' ORDER BY n) AS items
  FROM secondary WHERE n <= 3 GROUP BY ALL
)
"""

CARDS_SQL = """
lists AS (
  SELECT digest_day, block, country, sent_rank, tema, string_agg(tier_label || ': ' || items, chr(10) ORDER BY tier_label)
    AS also_in
  FROM mentions GROUP BY ALL
),
cards AS (
  SELECT r.digest_day, r.block, r.country, r.sent_rank, 0 AS section, r.best_tier AS card_tier, r.tema, r.scraped_ts, r.seq,
    r.title, r.snippet, r.source, r.domain, r.tier_label, r.link, r.sentiment, coalesce(l.also_in, '') AS also_in
  FROM ranked r LEFT JOIN lists l USING (digest_day, block, country, sent_rank, tema) WHERE r.rank = 1
  UNION ALL
  SELECT digest_day, block, country, sent_rank, 1, tier_order, tema, scraped_ts, seq, title, snippet, source, domain,
    tier_label, link, sentiment, ''
  FROM digest_rows WHERE tema = ''
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY digest_day, block, country
    ORDER BY sent_rank, section, card_tier, tema, scraped_ts, seq) AS position
  FROM cards
),
fields AS (
  SELECT digest_day, block, country, position, '' AS tag, trim(title) AS title, trim(snippet, chr(10) || ' ') AS snippet,
    source AS media, tier_label AS tier, trim(link) AS link,
    CASE WHEN block = 'competitor' THEN '' ELSE upper(trim(coalesce(sentiment, ''))) END AS sentiment, also_in
  FROM placed
)
"""

DAY_TEXT_SQL = "strftime(digest_day, '%Y-%m-%d')"


def day_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text, to compare results between engines."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def digest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_rows(items(spark, sf_dir))


def shown_rows(rows: DataFrame) -> DataFrame:
    """Items as digest rows."""
    return digest.digest_rows(digest.with_digest_day(flagged(rows).withColumn("country", map_country(F.col("country")))))


def digest_fields(spark: SparkSession, sf_dir: str, markup: bool = False) -> DataFrame:
    """The fields of all cards. Ten items share a document's texts, which are fetched for the placed cards by its number and their hash."""
    texts = item_texts(spark, sf_dir).withColumn("content", content_hash(["title", "snippet"]))
    rows = shown_rows(with_documents(item_log(spark, sf_dir), texts.drop("title", "snippet")))
    # Written without the texts, as topics, single rows and places are found from them one after the other.
    rows = written(rows.drop("title", "snippet", "url", "query", "published_utc", "date_utc", "scraped_utc", "scraped_at"), "digest-rows")
    by = ["doc_id", "content"]
    once = texts.select(*by, "title", "snippet").dropDuplicates(by)
    return digest.card_fields(digest.digest_cards(rows, markup=markup, texts=once, by=by))


@query(
    with_views(ITEMS_SQL)
    + """
    SELECT seq, block, CASE WHEN block = 'competitor' THEN enviar END AS enviar FROM items
    WHERE block = 'own' OR event_type IN ('view', 'click', 'purchase')
    """
)
def digest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both blocks; only the competitor table has the editorial flag here."""
    rows = items(spark, sf_dir).select("seq", "block", "enviar")
    own = rows.where("block = 'own'").select("seq")
    rivals = rows.where("block = 'competitor'").select("seq", "enviar")
    return digest.union_blocks(own, rivals).select("seq", "block", "enviar")


@query(
    with_views(ITEMS_SQL, ROWS_SQL)
    + f"""
    SELECT {DAY_TEXT_SQL} AS digest_day, strftime(digest_day - CASE isodow(digest_day) WHEN 1 THEN 3 ELSE 1 END, '%d/%m/%Y')
      || ' 09:00 - ' || strftime(digest_day, '%d/%m/%Y') || ' 09:00' AS label, block, count(*) AS n
    FROM digest_rows GROUP BY ALL
    """
)
def digest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per digest and block, with the label of its window."""
    rows = digest_rows(spark, sf_dir)
    counts = rows.groupBy("digest_day", "block").agg(F.count(F.lit(1)).alias("n"))
    return day_text(counts.withColumn("label", dates.digest_label(F.col("digest_day"))), "digest_day")


SLOT_SQL = """CASE WHEN hour(scraped_ts) >= 8 AND hour(scraped_ts) < 13 THEN '08-13'
  WHEN hour(scraped_ts) >= 13 AND hour(scraped_ts) < 18 THEN '13-18' ELSE '18-08' END"""
SLOT_DATE_SQL = "CAST(scraped_ts + INTERVAL 6 HOUR AS DATE)"


@query(
    with_views(ITEMS_SQL)
    + f"""
    SELECT strftime({SLOT_DATE_SQL}, '%Y-%m-%d') AS slot_date, {SLOT_SQL} AS slot, country, count(*) AS n
    FROM items GROUP BY ALL
    """
)
def digest_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per mailed slot and country."""
    local = F.col("scraped_ts")
    slots = items(spark, sf_dir).withColumns({"slot_date": dates.slot_date(local), "slot": dates.digest_slot(local)})
    return day_text(slots.groupBy("slot_date", "slot", "country").agg(F.count(F.lit(1)).alias("n")), "slot_date")


@query(
    with_views(ITEMS_SQL, ROWS_SQL)
    + "SELECT country, count(*) AS n, count(*) FILTER (tema <> '') AS with_topic FROM digest_rows GROUP BY country"
)
def by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest_rows(spark, sf_dir)
    counts = rows.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.count_if("has_topic").alias("with_topic"))
    return counts.orderBy("country")


TOPIC_COLUMNS = "block, country, CAST(sent_rank AS BIGINT) AS sent_rank, tema"


@query(
    with_views(ITEMS_SQL, ROWS_SQL)
    + f"""SELECT {DAY_TEXT_SQL} AS digest_day, {TOPIC_COLUMNS}, min(tier_order) AS best_tier
    FROM digest_rows WHERE tema <> '' GROUP BY ALL"""
)
def topic_best_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_text(digest.topic_best_tier(digest_rows(spark, sf_dir)), "digest_day")


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL)
    + f"SELECT {DAY_TEXT_SQL} AS digest_day, {TOPIC_COLUMNS}, seq, rank FROM ranked"
)
def rank_in_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every row in its topic."""
    ranked = digest.rank_in_topic(digest_rows(spark, sf_dir))
    return day_text(ranked.select(*digest.TOPIC, "seq", "rank"), "digest_day")


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL)
    + f"SELECT {DAY_TEXT_SQL} AS digest_day, {TOPIC_COLUMNS}, seq, title, best_tier FROM ranked WHERE rank = 1"
)
def topic_principal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of every topic and the topic's best tier."""
    leaders = digest.topic_leaders(digest_rows(spark, sf_dir)).where("is_principal")
    return day_text(leaders.select(*digest.TOPIC, "seq", "title", "best_tier"), "digest_day")


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL, SECONDARY_SQL)
    + f"SELECT {DAY_TEXT_SQL} AS digest_day, {TOPIC_COLUMNS}, tier_label, items FROM mentions"
)
def also_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secondaries that every topic lists, per tier."""
    return day_text(digest.also_in(digest.topic_leaders(digest_rows(spark, sf_dir))), "digest_day")


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL, SECONDARY_SQL, CARDS_SQL)
    + f"SELECT {DAY_TEXT_SQL} AS digest_day, block, country, seq, CAST(section AS BIGINT) AS section, position FROM placed"
)
def display_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every card in its digest."""
    cards = digest.digest_cards(digest_rows(spark, sf_dir))
    return day_text(cards.select(*digest.SECTION, "seq", "section", "position"), "digest_day")


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL, SECONDARY_SQL, CARDS_SQL)
    + f"SELECT * REPLACE ({DAY_TEXT_SQL} AS digest_day) FROM fields"
)
def digest_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cards of all digests with their displayed fields."""
    fields = digest_fields(spark, sf_dir)
    return day_text(fields, "digest_day")


CARD_TEXT_SQL = """concat_ws(chr(10), tag, title, snippet, 'Media: ' || media || ' | ' || tier, link,
    CASE WHEN block <> 'competitor' THEN 'Sentiment: ' || sentiment END,
    CASE WHEN also_in <> '' THEN 'También en:' || chr(10) || also_in END) || chr(10) || chr(10)"""
LABEL_SQL = """CASE block WHEN 'competitor' THEN 'Competencia' ELSE 'Own' END || ' — ' || country || ' ' ||
    CASE country WHEN 'Argentina' THEN '🇦🇷' WHEN 'Chile' THEN '🇨🇱' WHEN 'Peru' THEN '🇵🇪' ELSE '' END"""


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL, SECONDARY_SQL, CARDS_SQL)
    + f"""
    SELECT {DAY_TEXT_SQL} AS digest_day, block, country, (position - 1) // 50 + 1 AS part, count(*) AS cards,
      string_agg(CASE WHEN position = 1 THEN {LABEL_SQL} || chr(10) || chr(10) ELSE '' END || {CARD_TEXT_SQL}, ''
        ORDER BY position) AS document,
      'Newsletter (' || strftime(digest_day - CASE isodow(digest_day) WHEN 1 THEN 3 ELSE 1 END, '%d/%m/%Y')
        || ' 09:00 - ' || strftime(digest_day, '%d/%m/%Y') || ' 09:00)' AS subject, CASE block WHEN 'own' THEN 0 ELSE 1 END AS block_rank
    FROM fields GROUP BY ALL
    """
)
def digest_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every digest, in parts of fifty cards."""
    fields = digest_fields(spark, sf_dir)
    return day_text(documents(fields, cards_per_part=50), "digest_day")


@query(
    with_views(ITEMS_SQL)
    + f""", slots AS (
      SELECT *, strftime({SLOT_DATE_SQL}, '%Y-%m-%d') AS slot_date, {SLOT_SQL} AS slot FROM items WHERE country IS NOT NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY slot_date, slot, country ORDER BY scraped_ts, seq) AS position
      FROM slots)
    SELECT slot_date, slot, country, (position - 1) // 50 + 1 AS part, count(*) AS cards,
      string_agg(CASE WHEN position = 1 THEN '=== ' || country || ' ===' || chr(10) ELSE '' END
        || '- ' || trim(title) || ' (' || source || ')' || chr(10) || '  ' || trim(link) || chr(10), ''
        ORDER BY position) AS document
    FROM placed GROUP BY ALL
    """
)
def plain_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain list of every slot and country, in parts of fifty items."""
    local = F.col("scraped_ts")
    rows = items(spark, sf_dir).withColumns({"slot_date": dates.slot_date(local), "slot": dates.digest_slot(local)})
    return day_text(digest.plain_digest(rows, cards_per_part=50), "slot_date")


def escape_sql(value: str) -> str:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        value = f"replace({value}, '{char}', '{entity}')"
    return value


MARKUP_LISTS_SQL = f"""
html_tiers AS (
  SELECT digest_day, block, country, sent_rank, tema, tier_label, string_agg(CASE WHEN trim(coalesce(link, '')) <> ''
      THEN '<a href="' || {escape_sql('trim(link)')} || '">' || {escape_sql('source')} || '</a>' ELSE {escape_sql('source')} END, ' | ' ORDER BY n) AS items
  FROM secondary WHERE n <= 3 GROUP BY ALL),
html_lists AS (
  SELECT digest_day, block, country, sent_rank, tema, string_agg('<b>' || {escape_sql('tier_label')} || ':</b> ' || items, '<br>' ORDER BY tier_label) AS html_list
  FROM html_tiers GROUP BY ALL),
html_fields AS (
  SELECT f.*, CASE WHEN p.section = 0 THEN coalesce(l.html_list, '') ELSE '' END AS html_list
  FROM fields f JOIN placed p USING (digest_day, block, country, position)
  LEFT JOIN html_lists l ON l.digest_day = p.digest_day AND l.block = p.block AND l.country = p.country AND l.sent_rank = p.sent_rank AND l.tema = p.tema)
"""
CARD_HTML_SQL = f"""'<article><b>' || {escape_sql('tag')} || '</b><h3><a href="' || {escape_sql('link')} || '">' || {escape_sql('title')} || '</a></h3><p>'
    || {escape_sql('snippet')} || '</p><p>Media: ' || {escape_sql('media')} || ' | ' || {escape_sql('tier')} || '</p>'
    || CASE WHEN block <> 'competitor' THEN '<p>Sentiment: ' || {escape_sql('sentiment')} || '</p>' ELSE '' END
    || CASE WHEN html_list <> '' THEN '<p>También en:<br>' || html_list || '</p>' ELSE '' END || '</article>'"""


@query(
    with_views(ITEMS_SQL, ROWS_SQL, RANKED_SQL, SECONDARY_SQL, CARDS_SQL, MARKUP_LISTS_SQL)
    + f"""
    SELECT {DAY_TEXT_SQL} AS digest_day, block, country, CASE block WHEN 'own' THEN 0 ELSE 1 END AS block_rank, (position - 1) // 50 + 1 AS part,
      string_agg(CASE WHEN position = 1 THEN '<h2>' || {LABEL_SQL} || '</h2>' ELSE '' END || {CARD_HTML_SQL}, '' ORDER BY position) AS document
    FROM html_fields GROUP BY ALL
    """
)
def digest_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every digest as markup, the own block first, with links in the lists of further media."""
    fields = digest_fields(spark, sf_dir, markup=True)
    made = documents(fields, html=True, cards_per_part=50)
    return day_text(made.select("digest_day", "block", "country", "block_rank", "part", "document"), "digest_day")


# The digests of a Monday, a Thursday and a Sunday, from table text: stamps to the minute, weekends as any other day.
NOWS = (datetime(2024, 1, 8, 10, 30), datetime(2024, 1, 11, 8), datetime(2024, 1, 14, 23, 59))
NOW_SQL = f"""
days AS (SELECT unnest([{', '.join(f"DATE '{now:%Y-%m-%d}'" for now in NOWS)}]) AS digest_day),
digest_rows AS (
  SELECT *, CASE bucket WHEN 'POSITIVO (PROACTIVO)' THEN 0 WHEN 'POSITIVO' THEN 1 WHEN 'NEGATIVO' THEN 2 ELSE 3 END AS sent_rank
  FROM (
    SELECT i.* REPLACE ({COUNTRY_NAME_SQL} AS country, date_trunc('minute', scraped_ts) AS scraped_ts), n.digest_day,
      CASE WHEN block = 'competitor' THEN 'NEUTRO' ELSE {SENTIMENT_BUCKET_SQL} END AS bucket,
      CAST(coalesce(TRY_CAST(regexp_extract(coalesce(tier, ''), '([0-9]+)', 1) AS DOUBLE), 99) AS DOUBLE) AS tier_order,
      trim(coalesce(tier, '')) AS tier_label, CASE WHEN trim(coalesce(prioridad, '')) <> '' THEN 0 ELSE 1 END AS prio_rank
    FROM items i JOIN days n ON date_trunc('minute', scraped_ts) >= n.digest_day + INTERVAL 9 HOUR - CASE isodow(n.digest_day) WHEN 1 THEN INTERVAL 3 DAY ELSE INTERVAL 1 DAY END
      AND date_trunc('minute', scraped_ts) < n.digest_day + INTERVAL 9 HOUR
    WHERE event_type IN ('view', 'click', 'purchase') AND country IS NOT NULL)
)
"""


@query(
    with_views(ITEMS_SQL, NOW_SQL, RANKED_SQL, SECONDARY_SQL, CARDS_SQL)
    + f"""SELECT {DAY_TEXT_SQL} AS digest_day, block, country, position, title, link, tier, sentiment, also_in,
      'Newsletter (' || strftime(digest_day - CASE isodow(digest_day) WHEN 1 THEN 3 ELSE 1 END, '%d/%m/%Y')
        || ' 09:00 - ' || strftime(digest_day, '%d/%m/%Y') || ' 09:00)' AS subject FROM fields"""
)
def digest_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests that three days of a week mail, from the two tables as they are stored: all values text."""
    rows = items(spark, sf_dir).withColumn("country", map_country(F.col("country")))
    rows = rows.withColumn("scraped_at", F.date_format("scraped_ts", dates.STAMP_FORMAT)).drop("scraped_ts")
    own, rivals = (table_rows(rows.where(F.col("block") == block).drop("block")) for block in (digest.OWN, digest.COMPETITOR))
    found = reduce(DataFrame.unionByName, [cards(own, rivals, now) for now in NOWS])
    shown = found.withColumn("subject", digest.digest_subject(F.col("digest_day")))
    return day_text(shown.select("digest_day", "block", "country", "position", "title", "link", "tier", "sentiment", "also_in", "subject"), "digest_day")
