"""News tables derived from the driver's tables, in Spark and as SQL common table expressions.

`events` is the scrape log, `documents` are the articles, `pages` their stored web pages and
`labels` the editors' judgement. Ten scrapes go to one document and four documents to one page;
the event type decides in which link variant an item was seen. Every row of every table that a
query names is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.cells import lookup
from newsloom.functions.dates import to_local

EVENTS_PER_DOCUMENT = 10
DOCUMENTS_PER_PAGE = 4

COUNTRY_CODES = {"en": "ar", "es": "cl", "fr": "pe"}
LINK_VARIANTS = {"click": "/amp", "purchase": "?outputType=amp", "signup": "/ ", "error": ".amp/"}
FLAGS = {"view": " Sí ", "click": "SI", "purchase": "sí", "signup": "no"}
COMPETITOR_SOURCES = ("src14", "src15", "src16", "src17", "src18", "src19")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_of(body: Column) -> Column:
    """The first line of a document."""
    return F.split_part(body, F.lit("\n"), F.lit(1))


def snippet_of(body: Column) -> Column:
    """Everything after the first line."""
    return F.substring(body, F.length(title_of(body)) + 2, F.length(body))


def page_of(doc_id: Column) -> Column:
    return F.floor(doc_id / DOCUMENTS_PER_PAGE)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the link of its page."""
    documents = table(spark, sf_dir, "documents").withColumn("page_id", page_of(F.col("doc_id")))
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("link"))
    return documents.join(pages, "page_id", "left").select(
        "doc_id",
        "link",
        title_of(F.col("text")).alias("title"),
        snippet_of(F.col("text")).alias("snippet"),
        "text",
        "source",
        "lang",
        lookup(COUNTRY_CODES, F.col("lang"), F.col("lang")).alias("country"),
    )


def tier_of(k: Column) -> Column:
    return (
        F.when(k < 10, "n/a")
        .when(k < 20, "")
        .when(k < 25, F.lit(None))
        .when(k >= 85, " Tier 2b 3 ")
        .otherwise(F.concat(F.lit("Tier "), (k % 3 + 1).cast("string")))
    )


def sentiment_of(toxic: Column, quality: Column, event_type: Column) -> Column:
    return (
        F.when(toxic == 1, "Negativo")
        .when((quality == 1) & (event_type == "purchase"), "Positivo (proactivo)")
        .when(quality == 1, " positivo ")
        .when(quality == 0, "proactivo")
    )


def item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scraped items without what their document holds, to which `doc_id` leads (`item_texts`).

    Page and labels are joined by numbers that follow from the item's own.
    """
    events = table(spark, sf_dir, "events").withColumn("doc_id", F.floor(F.col("event_id") / EVENTS_PER_DOCUMENT))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels")
    joined = events.withColumn("page_id", page_of(F.col("doc_id"))).join(pages, "page_id", "left").join(labels, "doc_id", "left")
    kind = F.col("event_type")
    instant = F.col("ts").cast("timestamp")
    published = instant - F.make_dt_interval(hours=F.floor("value").cast("int"))
    return joined.select(
        F.col("event_id").alias("seq"),
        "doc_id",
        "url",
        kind.alias("event_type"),
        F.concat(F.col("url"), lookup(LINK_VARIANTS, kind, F.lit(""))).alias("link"),
        F.regexp_extract("url", r"://([^/]+)", 1).alias("domain"),
        kind.alias("query"),
        published.alias("published_utc"),
        F.when(kind == "error", "ayer")
        .when(kind == "click", F.date_format(published, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == "purchase", F.date_format(published, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .alias("date_utc"),
        instant.alias("scraped_utc"),
        to_local(instant).alias("scraped_ts"),
        F.concat(F.date_format(to_local(instant), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00")).alias("scraped_at"),
        sentiment_of(F.col("toxic"), F.col("quality"), kind).alias("sentiment"),
        tier_of(F.get_json_object("props", "$.k").cast("int")).alias("tier"),
        F.when(F.col("value") > 100, "x").when(F.col("value") > 60, " ").alias("prioridad"),
        lookup(FLAGS, kind, F.lit(None).cast("string")).alias("enviar"),
        F.col("quality").isNotNull().alias("labelled"),
    )


def item_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the documents hold of their items."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        title_of(F.col("text")).alias("title"),
        snippet_of(F.col("text")).alias("snippet"),
        "source",
        lookup(COUNTRY_CODES, F.col("lang"), F.col("lang")).alias("country"),
    )


def with_documents(log: DataFrame, documents: DataFrame) -> DataFrame:
    """The items with columns of their documents, `source` among them, and what follows from it."""
    return log.join(documents.hint("merge"), "doc_id").withColumns(
        {
            "tema": F.when(F.col("labelled"), F.col("source")).otherwise(""),
            "block": F.when(F.col("source").isin(*COMPETITOR_SOURCES), "competitor").otherwise("own"),
        }
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per scraped item; `scraped_ts` is the local wall clock, `scraped_utc` the instant.

    The texts are joined last: what reads none moves none, and what reads them moves them once.
    """
    return with_documents(item_log(spark, sf_dir), item_texts(spark, sf_dir)).select(
        *["seq", "doc_id", "url", "event_type", "link", "title", "snippet", "source", "domain", "country", "query", "published_utc", "date_utc"],
        *["scraped_utc", "scraped_ts", "scraped_at", "sentiment", "tier", "tema", "prioridad", "enviar", "labelled", "block"],
    )


ARTICLES_SQL = """
articles AS (
  SELECT d.doc_id, p.url AS link, split_part(d.text, chr(10), 1) AS title,
    substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS snippet, d.text, d.source, d.lang,
    CASE d.lang WHEN 'en' THEN 'ar' WHEN 'es' THEN 'cl' WHEN 'fr' THEN 'pe' ELSE d.lang END AS country
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id // 4
)
"""

ITEMS_SQL = """
items AS (
  SELECT e.event_id AS seq, d.doc_id, p.url, e.event_type,
    p.url || CASE e.event_type WHEN 'click' THEN '/amp' WHEN 'purchase' THEN '?outputType=amp'
      WHEN 'signup' THEN '/ ' WHEN 'error' THEN '.amp/' ELSE '' END AS link,
    split_part(d.text, chr(10), 1) AS title,
    substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS snippet,
    d.source, regexp_extract(p.url, '://([^/]+)', 1) AS domain,
    CASE d.lang WHEN 'en' THEN 'ar' WHEN 'es' THEN 'cl' WHEN 'fr' THEN 'pe' ELSE d.lang END AS country,
    e.event_type AS query,
    e.ts - to_hours(CAST(floor(e.value) AS BIGINT)) AS published_utc,
    e.ts AS scraped_utc, e.ts - INTERVAL 3 HOUR AS scraped_ts,
    CASE WHEN l.toxic = 1 THEN 'Negativo' WHEN l.quality = 1 AND e.event_type = 'purchase' THEN 'Positivo (proactivo)'
      WHEN l.quality = 1 THEN ' positivo ' WHEN l.quality = 0 THEN 'proactivo' END AS sentiment,
    CASE WHEN k < 10 THEN 'n/a' WHEN k < 20 THEN '' WHEN k < 25 THEN NULL WHEN k >= 85 THEN ' Tier 2b 3 '
      ELSE 'Tier ' || CAST(k % 3 + 1 AS VARCHAR) END AS tier,
    CASE WHEN l.doc_id IS NOT NULL THEN d.source ELSE '' END AS tema,
    CASE WHEN e.value > 100 THEN 'x' WHEN e.value > 60 THEN ' ' END AS prioridad,
    CASE e.event_type WHEN 'view' THEN ' Sí ' WHEN 'click' THEN 'SI' WHEN 'purchase' THEN 'sí'
      WHEN 'signup' THEN 'no' END AS enviar,
    l.doc_id IS NOT NULL AS labelled,
    CASE WHEN d.source IN ('src14','src15','src16','src17','src18','src19') THEN 'competitor' ELSE 'own' END AS block
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
  JOIN documents d ON d.doc_id = e.event_id // 10
  LEFT JOIN pages p ON p.page_id = d.doc_id // 4
  LEFT JOIN labels l ON l.doc_id = d.doc_id
)
"""

COUNTRY_NAME_SQL = "CASE country WHEN 'ar' THEN 'Argentina' WHEN 'cl' THEN 'Chile' WHEN 'pe' THEN 'Peru' ELSE country END"


def suffix_sql(column: str, passes: int) -> str:
    """The copy-ending rule in SQL, `passes` times."""
    # The endings, as in `functions.links`.
    sql = column
    for _ in range(passes):
        sql = (
            f"regexp_replace(trim({sql}), "
            r"'(/amp/?|=amp|=amp-type|\?outputType|\?outputType=amp-type|\.amp|/)$', '')"
        )
    return sql


def query_cut_sql(column: str) -> str:
    """The query and fragment rule in SQL."""
    return f"regexp_replace(regexp_replace(trim({column}), '[?#].*$', ''), '/+$', '')"


def fold_sql(column: str) -> str:
    """Accent-free upper-case text with single blanks in SQL."""
    return rf"trim(regexp_replace(replace(upper(strip_accents({column})), 'ẞ', 'SS'), '\s+', ' ', 'g'))"


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)
