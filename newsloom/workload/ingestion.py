"""Filters, deduplication, key joins and whole ingestion runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.dates import format_scraped_at, local_date_text, parse_utc, to_local, window_bounds
from newsloom.functions.links import article_id, extract_resolved_url, extract_signature, is_unresolved
from newsloom.functions.links import normalize_link_suffix, url_key
from newsloom.functions.text import fold
from newsloom.operators import dedupe, filters, joins, metrics
from newsloom.operators.terms import term_match as match_terms, texts_without_terms
from newsloom.plans.ingest import CLIPPING_FEED, COMPETITOR_FEED, OWN_FEED, FeedConfig, clean_feed, ingest, new_rows
from newsloom.session import shared_dir
from newsloom.sources.feeds import union_feeds as union_all
from newsloom.sources.tables import INGEST_DAY, read_target, stored_names
from newsloom.workload.registry import query
from newsloom.workload.views import (
    ARTICLES_SQL,
    COUNTRY_NAME_SQL,
    ITEMS_SQL,
    articles,
    fold_sql,
    item_log,
    item_texts,
    items,
    query_cut_sql,
    suffix_sql,
    table,
    with_views,
)

MONDAY = datetime(2024, 1, 8, 10, 0)
TODAY = date(2024, 1, 16)
PUBLISHED_LOCAL_SQL = "CAST(published_utc - INTERVAL 3 HOUR AS DATE)"
READABLE_DATE_SQL = "event_type <> 'error'"

# Patterns and terms that occur in the given texts.
BRAND_PATTERN = r"lich\s*-?\s*keit(en)?|redes?\s+sociales?|leaux\s+les?"
RIVAL_PATTERN = r"(heit|cionn|ndthe|ouan)"
INCLUDE = ("license", "cheu", "Hänsh", "UNGEN", "éreau", "scher", "reau", "eaux")
EXCLUDE = ("mente", "copyright")


@query(
    with_views(ITEMS_SQL)
    + rf"""
    SELECT seq, title FROM items
    WHERE regexp_matches(title, '(?i){BRAND_PATTERN}') OR regexp_matches(snippet, '(?i){BRAND_PATTERN}')
       OR regexp_matches(title, '(?i){d.OWN_PATTERN}') OR regexp_matches(snippet, '(?i){d.OWN_PATTERN}')
    """
)
def brand_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default brand pattern or one that occurs in the texts."""
    rows = items(spark, sf_dir).select("seq", "title", "snippet")
    return filters.mentions_brand(rows, f"(?:{d.OWN_PATTERN}|{BRAND_PATTERN})").select("seq", "title")


@query(
    with_views(ITEMS_SQL)
    + f"""
    SELECT seq, title FROM items
    WHERE regexp_matches(title, '(?i){RIVAL_PATTERN}') OR regexp_matches(snippet, '(?i){RIVAL_PATTERN}')
    """
)
def competitor_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).select("seq", "title", "snippet")
    return filters.mentions_competitor(rows, RIVAL_PATTERN).select("seq", "title")


def any_term_sql(folded: str, terms: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({folded}, {fold_sql(chr(39) + t + chr(39))})" for t in terms) + ")"


RELEVANT_SQL = f"""
folded AS MATERIALIZED (SELECT *, {fold_sql("title || ' ' || snippet || ' '")} AS f FROM articles),
relevant AS (
  SELECT * FROM folded
  WHERE {any_term_sql('f', INCLUDE + d.INCLUDE_TERMS)} AND NOT {any_term_sql('f', EXCLUDE + d.EXCLUDE_TERMS)}
)
"""


@query(with_views(ARTICLES_SQL, RELEVANT_SQL) + "SELECT doc_id, title FROM relevant")
def keyword_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Include and exclude terms: the listed ones and some that occur in the texts."""
    rows = articles(spark, sf_dir).select("doc_id", "title", "snippet")
    return filters.relevance(rows, INCLUDE + d.INCLUDE_TERMS, EXCLUDE + d.EXCLUDE_TERMS).select("doc_id", "title")


# One term per word of the benchmark texts, of any length; the table grows with them.
TERMS_SQL = f"""
terms AS (
  SELECT DISTINCT term FROM (
    SELECT unnest(string_split_regex({fold_sql('text')}, '[^A-Z]+')) AS term FROM benchmark)
  WHERE term <> ''
)
"""
# The last word of each benchmark text, and its first two.
LAST_WORDS_SQL = f"terms AS (SELECT DISTINCT regexp_extract({fold_sql('text')}, '([A-Z]+)[^A-Z]*$', 1) AS term FROM benchmark)"
OPENINGS_SQL = f"terms AS (SELECT DISTINCT regexp_extract({fold_sql('text')}, '^[^ ]+ [^ ]+', 0) AS term FROM benchmark)"


def benchmark_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split(fold(F.col("text")), "[^A-Z]+")
    terms = table(spark, sf_dir, "benchmark").select(F.explode(words).alias("term"))
    return terms.where(F.col("term") != "").distinct()


def folded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", fold(F.col("text")).alias("folded"))


@query(
    with_views(TERMS_SQL)
    + f""", folded AS MATERIALIZED (SELECT doc_id, {fold_sql('text')} AS f FROM documents)
    SELECT doc_id, term FROM folded JOIN terms ON contains(f, term)
    """
)
def term_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the terms of a term table they contain, inside words too."""
    return match_terms(folded_documents(spark, sf_dir), benchmark_terms(spark, sf_dir), ["doc_id"])


@query(
    with_views(LAST_WORDS_SQL)
    + f""", folded AS MATERIALIZED (SELECT doc_id, {fold_sql('text')} AS f FROM documents)
    SELECT doc_id FROM folded WHERE NOT EXISTS (SELECT 1 FROM terms WHERE term <> '' AND contains(f, term))
    """
)
def term_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the last word of any benchmark text."""
    last = F.regexp_extract(fold(F.col("text")), "([A-Z]+)[^A-Z]*$", 1)
    terms = table(spark, sf_dir, "benchmark").select(last.alias("term")).distinct()
    return texts_without_terms(folded_documents(spark, sf_dir), terms, ["doc_id"]).select("doc_id")


@query(
    with_views(OPENINGS_SQL)
    + f""", folded AS MATERIALIZED (SELECT doc_id, {fold_sql('text')} AS f FROM documents)
    SELECT doc_id, term FROM folded JOIN terms ON term <> '' AND contains(f, term)
    """
)
def term_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the openings of benchmark texts, two words each, that stand in them."""
    opening = F.regexp_extract(fold(F.col("text")), "^[^ ]+ [^ ]+", 0)
    terms = table(spark, sf_dir, "benchmark").select(opening.alias("term")).distinct()
    return match_terms(folded_documents(spark, sf_dir), terms, ["doc_id"])


@query(
    with_views(ITEMS_SQL)
    + f"""
    SELECT seq, strftime({PUBLISHED_LOCAL_SQL}, '%d/%m/%Y') AS date_utc,
      strftime(scraped_ts, '%d/%m/%Y %H:%M') AS scraped_at
    FROM items WHERE {READABLE_DATE_SQL} AND {PUBLISHED_LOCAL_SQL} BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'
    """
)
def recent_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of today and yesterday, from dates in four formats and unreadable ones."""
    dated = items(spark, sf_dir).withColumn("published_day", F.to_date(to_local(parse_utc(F.col("date_utc")))))
    return filters.recent_days(dated, TODAY).select(
        "seq", local_date_text(F.col("date_utc")).alias("date_utc"), format_scraped_at(F.col("scraped_at")).alias("scraped_at")
    )


# Spellings of a publication instant by number; the last two cannot be read as a date.
SPELLINGS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "EEE, dd MMM yyyy HH:mm:ss 'GMT'", "yyyy-MM-dd HH:mm:ss", "d MMM yyyy H:mm", "MMM d, yyyy H:mm:ss",
    "yyyy/M/d H:mm", "yyyy/MM/dd", "dd MMM yyyy", "MMMM d, yyyy", "EEEE, d MMM yyyy HH:mm:ss '-0200'", "HH:mm", "'ayer a las 'HH",
)


@query(
    with_views(ITEMS_SQL)
    + f"""SELECT seq, CASE WHEN k < 6 THEN strftime(published_utc - INTERVAL 3 HOUR, '%d/%m/%Y')
        WHEN k < 9 THEN strftime(date_trunc('day', published_utc) - INTERVAL 3 HOUR, '%d/%m/%Y')
        WHEN k = 9 THEN strftime(published_utc - INTERVAL 1 HOUR, '%d/%m/%Y') ELSE '' END AS date_utc
    FROM (SELECT *, seq % {len(SPELLINGS)} AS k FROM items)"""
)
def local_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local dates of instants in ten spellings; a bare time and words are no date."""
    rows, kind = items(spark, sf_dir), F.col("seq") % len(SPELLINGS)
    spelled = F.lit(None).cast("string")
    for number, pattern in enumerate(SPELLINGS):
        spelled = F.when(kind == number, F.date_format("published_utc", pattern)).otherwise(spelled)
    return rows.select("seq", local_date_text(spelled).alias("date_utc"))


@query(
    with_views(ITEMS_SQL)
    + """
    SELECT seq, block, '05/01/2024 09:00 - 08/01/2024 09:00' AS label FROM items
    WHERE scraped_ts >= TIMESTAMP '2024-01-05 09:00:00' AND scraped_ts < TIMESTAMP '2024-01-08 09:00:00'
    """
)
def digest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one Monday's digest."""
    rows = filters.digest_window(items(spark, sf_dir), MONDAY)
    return rows.select("seq", "block", F.lit(window_bounds(MONDAY).label).alias("label"))


@query(with_views(ITEMS_SQL) + "SELECT seq, enviar FROM items WHERE event_type IN ('view', 'click', 'purchase')")
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.flagged(items(spark, sf_dir)).select("seq", "enviar")


NEW_KEYS_SQL = f"""
keyed AS (SELECT seq, labelled, {suffix_sql('link', 4)} AS link_key FROM items),
existing AS (SELECT DISTINCT link_key FROM keyed WHERE labelled),
fresh AS (
  SELECT link_key, min(seq) AS seq FROM keyed
  WHERE NOT labelled AND link_key <> '' AND link_key NOT IN (SELECT link_key FROM existing) GROUP BY link_key
)
"""


def keyed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their key; the ones that editors have labelled are in the table already."""
    key = normalize_link_suffix(F.col("link"), 4)
    return items(spark, sf_dir).select("seq", "labelled", key.alias("link_key"))


@query(with_views(ITEMS_SQL, NEW_KEYS_SQL) + "SELECT link_key, seq FROM fresh")
def only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first item of every key that the table lacks."""
    keyed = keyed_items(spark, sf_dir)
    fresh = dedupe.dedupe_by_link(filters.has_key(keyed.where(~F.col("labelled"))), ["seq"])
    return joins.only_new(fresh, keyed.where("labelled")).select("link_key", "seq")


@query(
    with_views(ITEMS_SQL, NEW_KEYS_SQL)
    + """
    SELECT link_key, seq, 'new' AS origin FROM fresh
    UNION ALL SELECT link_key, min(seq), 'existing' FROM keyed WHERE labelled AND link_key <> '' GROUP BY link_key
    """
)
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the append: what it held and what it lacked."""
    keyed = filters.has_key(keyed_items(spark, sf_dir))
    target = dedupe.dedupe_by_link(keyed.where("labelled"), ["seq"])
    fresh = joins.only_new(dedupe.dedupe_by_link(keyed.where(~F.col("labelled")), ["seq"]), target)
    both = target.withColumn("origin", F.lit("existing")).unionByName(fresh.withColumn("origin", F.lit("new")))
    return both.select("link_key", "seq", "origin")


@query(
    with_views(ITEMS_SQL)
    + f"SELECT {suffix_sql('link', 2)} AS link_key, min(seq) AS seq FROM items GROUP BY 1"
)
def dedupe_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = items(spark, sf_dir).select("seq", normalize_link_suffix(F.col("link"), 2).alias("link_key"))
    return dedupe.dedupe_by_link(keyed, ["seq"]).select("link_key", "seq")


@query(
    with_views(ITEMS_SQL)
    + """
    SELECT seq, title, link FROM items
    QUALIFY row_number() OVER (PARTITION BY title, snippet ORDER BY seq) = 1
    """
)
def dedupe_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).select("seq", "title", "snippet", "link")
    return dedupe.dedupe_by_content(rows, ["seq"]).select("seq", "title", "link")


@query(with_views(ITEMS_SQL) + "SELECT DISTINCT trim(link) AS url_key FROM items WHERE link IS NOT NULL")
def distinct_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = items(spark, sf_dir).select(url_key(F.col("link")).alias("url_key"))
    return dedupe.distinct_links(keys, "url_key")


@query(
    with_views(ITEMS_SQL)
    + """
    SELECT seq, query, country FROM items
    QUALIFY row_number() OVER (PARTITION BY query, country ORDER BY scraped_utc, seq) <= 500
    """
)
def source_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first items of every query and country, up to the default limit."""
    rows = items(spark, sf_dir).select("seq", "query", "country", "scraped_utc")
    return dedupe.source_cap(rows, ["scraped_utc", "seq"], d.MAX_ITEMS).select("seq", "query", "country")


@query(
    with_views(ITEMS_SQL)
    + """
    SELECT seq, link, CASE WHEN block = 'own' THEN tier END AS tier, CASE WHEN block = 'own' THEN NULL ELSE enviar END AS enviar
    FROM items
    """
)
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds with different columns as one."""
    rows = items(spark, sf_dir)
    own = rows.where("block = 'own'").select("seq", "link", "tier")
    rivals = rows.where("block = 'competitor'").select("enviar", "seq", "link")
    return union_all([own, rivals]).select("seq", "link", "tier", "enviar")


REDIRECTS_SQL = """
redirects AS (
  SELECT seq, event_type, CASE event_type
      WHEN 'error' THEN 'https://news.google.com/rss/articles/CBM' || CAST(p.page_id AS VARCHAR) || '?hl=es'
      WHEN 'signup' THEN 'https://example.com/goto?url=CBM' || CAST(p.page_id AS VARCHAR) || '&k=1'
      ELSE link END AS link
  FROM items i JOIN pages p ON p.url = i.url
)
"""


def redirect_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of which some were only seen as redirects to a page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    kind, page = F.col("event_type"), F.col("page_id").cast("string")
    link = (
        F.when(kind == "error", F.concat(F.lit("https://news.google.com/rss/articles/CBM"), page, F.lit("?hl=es")))
        .when(kind == "signup", F.concat(F.lit("https://example.com/goto?url=CBM"), page, F.lit("&k=1")))
        .otherwise(F.col("link"))
    )
    return items(spark, sf_dir).join(pages, "url").select("seq", "event_type", link.alias("link"))


def resolver_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored resolver answers; pages under `/es/` were never resolved."""
    pages = table(spark, sf_dir, "pages").where(~F.contains(F.col("url"), F.lit("/es/")))
    return pages.select(
        F.concat(F.lit("CBM"), F.col("page_id").cast("string")).alias("article_id"),
        F.concat(F.lit(')]}\' [["wrb.fr","x","["garturlres","'), F.col("url"), F.lit('",1]"]]')).alias("response"),
    )


@query(
    with_views(ITEMS_SQL, REDIRECTS_SQL)
    + """
    SELECT r.seq, CASE WHEN contains(r.link, 'news.google.com') OR contains(r.link, '/goto?url=')
        THEN coalesce(p.url, r.link) ELSE r.link END AS link
    FROM redirects r LEFT JOIN (SELECT * FROM pages WHERE NOT contains(url, '/es/')) p
      ON 'CBM' || CAST(p.page_id AS VARCHAR)
         = coalesce(nullif(regexp_extract(r.link, 'articles/([^?]+)', 1), ''), regexp_extract(r.link, 'url=([^&]+)', 1))
    """
)
def resolve_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirects replaced by their stored targets."""
    responses = resolver_responses(spark, sf_dir)
    resolved = responses.select("article_id", extract_resolved_url(F.col("response")).alias("resolved"))
    return joins.resolve_links(redirect_items(spark, sf_dir), resolved).select("seq", "link")


@query(
    with_views(ITEMS_SQL, REDIRECTS_SQL)
    + """
    SELECT seq, event_type IN ('error', 'signup') AS waiting,
      CASE WHEN event_type IN ('error', 'signup') THEN regexp_extract(link, '(CBM[0-9]+)', 1) END AS article_id
    FROM redirects
    """
)
def redirect_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = is_unresolved(F.col("link"))
    return redirect_items(spark, sf_dir).select(
        "seq", waiting.alias("waiting"), F.when(waiting, article_id(F.col("link"))).alias("article_id")
    )


@query(
    """
    SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE 'S' || CAST(page_id AS VARCHAR) END AS signature,
      CASE WHEN contains(url, '?') THEN NULL ELSE CAST(length(html) AS VARCHAR) END AS stamp
    FROM pages
    """
)
def redirect_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signature and stamp from stored redirect pages; pages with a query carry no stamp."""
    pages = table(spark, sf_dir, "pages")
    mark = F.concat(
        F.lit('<c-wiz data-n-a-sg="S'),
        F.col("page_id").cast("string"),
        F.lit('"'),
        F.when(F.contains(F.col("url"), F.lit("?")), "").otherwise(
            F.concat(F.lit(' data-n-a-ts="'), F.length("html").cast("string"), F.lit('"'))
        ),
        F.lit(">"),
    )
    stored = pages.select("page_id", F.concat(F.col("html"), mark).alias("page"))
    found = stored.select("page_id", extract_signature(F.col("page")).alias("s"))
    return found.select("page_id", F.col("s.signature").alias("signature"), F.col("s.stamp").alias("stamp"))


@query(
    with_views(ITEMS_SQL)
    + f""", keyed AS (
      SELECT *, {suffix_sql('link', 2)} AS link_key, {READABLE_DATE_SQL} AND {PUBLISHED_LOCAL_SQL}
        BETWEEN DATE '2024-01-15' AND DATE '2024-01-16' AS recent,
        regexp_matches(title, '(?i){RIVAL_PATTERN}') OR regexp_matches(snippet, '(?i){RIVAL_PATTERN}') AS brand
      FROM items),
    firsts AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY link_key ORDER BY seq) = 1),
    n AS (SELECT count(*) AS r, count(*) FILTER ({READABLE_DATE_SQL}) AS a, count(*) FILTER (recent) AS b, count(*) FILTER (recent AND brand) AS c,
      count(*) FILTER (recent AND brand AND NOT labelled) AS d FROM firsts)
    SELECT 1::BIGINT AS step_no, 'readable date' AS step, r AS rows_before, a AS rows_after, r - a AS removed FROM n
    UNION ALL SELECT 2, 'recent days', a, b, a - b FROM n
    UNION ALL SELECT 3, 'brand', b, c, b - c FROM n
    UNION ALL SELECT 4, 'not labelled yet', c, d, c - d FROM n
    """
)
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after each filter of the first copies."""
    keyed = items(spark, sf_dir).withColumn("link_key", normalize_link_suffix(F.col("link"), 2))
    firsts = dedupe.dedupe_by_link(keyed, ["seq"])
    day = F.to_date(to_local(parse_utc(F.col("date_utc"))))
    return metrics.funnel(
        firsts,
        {
            "readable date": day.isNotNull(),
            "recent days": day.between(F.lit(date(2024, 1, 15)), F.lit(TODAY)),
            "brand": filters.matches(RIVAL_PATTERN, F.col("title"), F.col("snippet")),
            "not labelled yet": ~F.col("labelled"),
        },
    )


FEED_COLUMNS = ("seq", "link", "title", "snippet", "domain", "source", "date_utc", "country", "query", "scraped_at")
# What the feed holds of an item itself; title, snippet, source and country come with its document.
LOG_COLUMNS = ("seq", "doc_id", "link", "domain", "date_utc", "query", "scraped_at")


def run_feed(spark: SparkSession, sf_dir: str, config: FeedConfig, refine=None) -> DataFrame:
    """New rows of the whole item feed; the negative items are in the table already."""
    rows = items(spark, sf_dir)
    existing = rows.where("sentiment = 'Negativo'").select(config.key(F.col("link")).alias("link_key"))
    feed = item_log(spark, sf_dir).select(*LOG_COLUMNS)
    clean = clean_feed(feed, config, TODAY, ["seq"], refine=refine, texts=item_texts(spark, sf_dir))
    return new_rows(clean, existing, config)


def fresh_sql(steps: str, last: str, key: str, header: str) -> str:
    return with_views(ITEMS_SQL, steps) + f"""
    SELECT {header}, link_key FROM {last}
    WHERE link_key <> '' AND link_key NOT IN (SELECT {key} FROM items WHERE sentiment = 'Negativo')
    """


def first_sql(source: str, keys: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY seq) = 1"


DATE_TEXT_SQL = f"CASE WHEN {READABLE_DATE_SQL} THEN strftime({PUBLISHED_LOCAL_SQL}, '%d/%m/%Y') ELSE '' END"
RECENT_SQL = f"{READABLE_DATE_SQL} AND {PUBLISHED_LOCAL_SQL} BETWEEN DATE '2024-01-15' AND DATE '2024-01-16'"
RIVAL_SQL = f"(regexp_matches(title, '(?i){RIVAL_PATTERN}') OR regexp_matches(snippet, '(?i){RIVAL_PATTERN}'))"

OWN_SQL = f"""
a AS (SELECT * REPLACE ({suffix_sql('link', 2)} AS link) FROM items),
b AS ({first_sql('a', 'link')}),
c AS (SELECT * FROM b WHERE {RECENT_SQL} AND {RIVAL_SQL}),
d AS (SELECT * REPLACE ({suffix_sql('link', 1)} AS link) FROM c),
e AS ({first_sql('d', 'link')}),
f AS ({first_sql('e', 'title, snippet')}),
g AS (SELECT *, {suffix_sql('link', 1)} AS link_key FROM f),
h AS ({first_sql('g', 'link_key')})
"""


OWN_COLUMNS_SQL = f"""'' AS semana, {DATE_TEXT_SQL} AS date_utc, {COUNTRY_NAME_SQL} AS country, title, link, domain, source, '' AS tier,
        snippet, '' AS tag, '' AS sentiment, strftime(scraped_ts, '%d/%m/%Y %H:%M') AS scraped_at"""


@query(fresh_sql(OWN_SQL, "h", suffix_sql("link", 1), OWN_COLUMNS_SQL))
def ingest_own(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own feed's run, with a brand that occurs in the texts."""
    return run_feed(spark, sf_dir, replace(OWN_FEED, pattern=RIVAL_PATTERN))


@query(fresh_sql(OWN_SQL, "h", suffix_sql("link", 2), OWN_COLUMNS_SQL))
def ingest_into_header_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own feed's run into a table that calls every column otherwise and holds the negative items without keys."""
    path = shared_dir(spark, "sheet")
    feed = items(spark, sf_dir)
    names = {name: f"hoja_{n}" if name != "link" else "enlace" for n, name in enumerate(d.OWN_HEADER)}
    sheet = feed.where("sentiment = 'Negativo'").select(*[F.col(n) if n == "link" else F.lit("x").alias(n) for n in d.OWN_HEADER])
    sheet.withColumnsRenamed(names).withColumn(INGEST_DAY, F.lit(TODAY)).write.partitionBy(INGEST_DAY).parquet(path)
    config = replace(OWN_FEED, pattern=RIVAL_PATTERN)
    for _run in ("first", "again"):
        ingest(item_log(spark, sf_dir).select(*LOG_COLUMNS), path, config, TODAY, ["seq"], texts=item_texts(spark, sf_dir))
    stored = read_target(spark, path, d.OWN_HEADER, names=stored_names(spark, path, d.OWN_HEADER))
    return stored.where("link_key IS NOT NULL").select(*d.OWN_HEADER, "link_key")


def competitor_steps_sql(source: str = "items", mark: str = "") -> str:
    return f"""
a{mark} AS (SELECT * REPLACE ({query_cut_sql('link')} AS link) FROM {source}),
b{mark} AS ({first_sql('a' + mark, 'link')}),
c{mark} AS (SELECT * FROM b{mark} WHERE {RIVAL_SQL}),
d{mark} AS (SELECT *, {query_cut_sql('link')} AS link_key FROM c{mark}),
e{mark} AS ({first_sql('d' + mark, 'link_key')})
"""


COMPETITOR_SQL = competitor_steps_sql()


@query(
    with_views(
        ITEMS_SQL,
        "early AS (SELECT * FROM items WHERE event_type IN ('view', 'click'))",
        competitor_steps_sql("early", "1"),
        competitor_steps_sql("items", "2"),
    )
    + f"""
    SELECT {DATE_TEXT_SQL} AS date_utc, title, link, source, link_key FROM (
      SELECT * FROM e1 WHERE link_key <> '' UNION ALL SELECT * FROM e2 WHERE link_key <> '' AND link_key NOT IN (SELECT link_key FROM e1))
    """
)
def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed target that gets a part of the feed, then all of it, then all of it again."""
    path = shared_dir(spark, "target")
    feed = item_log(spark, sf_dir).select(*LOG_COLUMNS, "event_type")
    config = replace(COMPETITOR_FEED, pattern=RIVAL_PATTERN)
    for part in (feed.where(F.col("event_type").isin("view", "click")), feed, feed):
        ingest(part.drop("event_type"), path, config, TODAY, ["seq"], buckets=16, texts=item_texts(spark, sf_dir))
    return read_target(spark, path, d.COMPETITOR_HEADER, buckets=16).select("date_utc", "title", "link", "source", "link_key")


@query(
    fresh_sql(
        COMPETITOR_SQL,
        "e",
        query_cut_sql("link"),
        f"""{DATE_TEXT_SQL} AS date_utc, {COUNTRY_NAME_SQL} AS country, title, link, domain, source, snippet, '' AS tag,
        strftime(scraped_ts, '%d/%m/%Y %H:%M') AS scraped_at, '' AS tier, '' AS enviar""",
    )
)
def ingest_competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The competitor feed's run, with a pattern that occurs in the texts."""
    return run_feed(spark, sf_dir, replace(COMPETITOR_FEED, pattern=RIVAL_PATTERN))


CLIPPING_SQL = f"""
a AS ({first_sql('items', 'link')}),
b AS (SELECT * FROM a WHERE {RECENT_SQL}),
c AS MATERIALIZED (SELECT *, {fold_sql("title || ' ' || snippet || ' '")} AS fo FROM b),
d AS (SELECT * FROM c WHERE {any_term_sql('fo', INCLUDE)} AND NOT {any_term_sql('fo', EXCLUDE)}),
e AS ({first_sql('d', 'link')}),
f AS ({first_sql('e', 'title, snippet')}),
g AS (SELECT *, trim(link) AS link_key FROM f),
h AS ({first_sql('g', 'link_key')})
"""


@query(
    fresh_sql(
        CLIPPING_SQL,
        "h",
        "trim(link)",
        f"""{DATE_TEXT_SQL} AS date_utc, CASE country WHEN 'ar' THEN 'Argentina' ELSE country END AS country, title, link,
        domain, source, snippet, '' AS tag, strftime(scraped_ts, '%d/%m/%Y %H:%M') AS scraped_at""",
    )
)
def ingest_clipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clipping feed's run with its relevance filter, with terms that occur in the texts."""
    return run_feed(spark, sf_dir, CLIPPING_FEED, lambda rows: filters.relevance(rows, INCLUDE, EXCLUDE))
