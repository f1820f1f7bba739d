"""Whole jobs over the given tables: from stored pages and answers to tagged rows and cache entries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions import labels
from newsloom.functions.html import body_text
from newsloom.functions.links import normalize_link_suffix, url_key
from newsloom.operators import filters, joins
from newsloom.plans import classify, jobs
from newsloom.plans.ingest import OWN_FEED
from newsloom.session import shared_dir
from newsloom.sources.tables import read_target
from newsloom.workload.cleaning import PARAGRAPHS_SQL, category_case_sql, sql_list
from newsloom.workload.enrichment import BODIES_SQL, RULES, quality_cache
from newsloom.workload.ingestion import EXCLUDE, INCLUDE, LOG_COLUMNS, OWN_SQL, RECENT_SQL, RIVAL_PATTERN, TODAY, any_term_sql, first_sql
from newsloom.workload.registry import query
from newsloom.workload.views import ARTICLES_SQL, ITEMS_SQL, articles, fold_sql, item_log, item_texts, page_of, suffix_sql, table, with_views

JOB_SQL = (
    with_views(
        ARTICLES_SQL,
        PARAGRAPHS_SQL,
        BODIES_SQL,
        """
answers AS (
  SELECT CAST(conv_id AS VARCHAR) AS key, text AS raw FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(text, '') <> '' DESC, length(coalesce(text, '')) DESC, text DESC) = 1)
""",
    )
    + f""", joined AS MATERIALIZED (
      SELECT a.doc_id, CAST(a.doc_id AS VARCHAR) AS key, a.title, a.snippet, coalesce(b.article_body, '') AS body
      FROM articles a LEFT JOIN bodies b ON b.url = a.link),
    relevant AS MATERIALIZED (
      SELECT *, {fold_sql("trim(title, chr(10) || ' ') || ' ' || trim(snippet, chr(10) || ' ') || ' ' || body")} AS f
      FROM (SELECT *, {fold_sql("title || ' ' || snippet || ' ' || body")} AS whole FROM joined)
      WHERE {any_term_sql('whole', INCLUDE)} AND NOT {any_term_sql('whole', EXCLUDE)}),
    known AS MATERIALIZED (
      SELECT r.doc_id, r.key, CASE WHEN l.quality = 1 THEN 'good' WHEN l.doc_id IS NOT NULL THEN '' END AS cached, r.f, a.raw
      FROM relevant r LEFT JOIN labels l ON l.doc_id = r.doc_id LEFT JOIN answers a ON a.key = r.key),
    ruled AS MATERIALIZED (SELECT *, CASE WHEN cached IS NULL THEN {category_case_sql('f', tuple(RULES), RULES)} END AS rule,
      {fold_sql("coalesce(raw, '')")} AS rf FROM known),
    tagged AS MATERIALIZED (
      SELECT doc_id, key, CASE WHEN cached IS NOT NULL THEN 'cache' WHEN rule IS NOT NULL THEN 'rules' ELSE 'labeller' END AS tag_origin,
        coalesce(cached, rule, CASE WHEN starts_with(trim(coalesce(raw, '')), '(')
          OR starts_with(lower(trim(coalesce(raw, ''))), 'por favor')
          OR contains(lower(coalesce(raw, '')), 'proporciona la noticia') THEN {sql_list([d.CLIPPING_DEFAULT_CATEGORY])} END,
          {category_case_sql('rf', d.CATEGORIES, d.CATEGORY_TERMS)}, {sql_list([d.CLIPPING_DEFAULT_CATEGORY])}) AS tag
      FROM ruled)
    """
)


def tagged_clippings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with the body of their page, kept by relevance of title, snippet and body, then tagged.

    The cache holds the editors' labels; the labeller's answers are the longest turn of the conversation
    with the document's number.
    """
    pages = table(spark, sf_dir, "pages")
    bodies = pages.select(url_key(F.col("url")).alias("link_key"), body_text(F.col("html")).alias("article_body"))
    rows = articles(spark, sf_dir).withColumn("link_key", url_key(F.col("link")))
    rows = joins.attach_body(rows, bodies, key="link_key").withColumn("url_key", F.col("doc_id").cast("string"))
    relevant = filters.relevance(rows.select("doc_id", "url_key", "title", "snippet", "article_body"), INCLUDE, EXCLUDE)
    answers = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("key"), F.col("text").alias("raw"))
    return classify.classify(
        relevant,
        quality_cache(spark, sf_dir),
        classify.stored_labeller(answers),
        rules=lambda folded: labels.category_by_rules(folded, RULES, tuple(RULES)),
        order=["doc_id"],
    )


@query(JOB_SQL + "SELECT doc_id, tag_origin, tag FROM tagged")
def clipping_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clipping feed from pages to tags."""
    return tagged_clippings(spark, sf_dir).select("doc_id", "tag_origin", "tag")


@query(JOB_SQL + "SELECT key, tag AS value FROM tagged WHERE tag_origin <> 'cache'")
def clipping_cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job adds to the cache, one entry per key."""
    return classify.new_labels(tagged_clippings(spark, sf_dir))


def stored_answers(spark: SparkSession, sf_dir: str, key: Callable[[Column], Column]) -> DataFrame:
    """Raw answers by link: all turns of the conversation with the page's number."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("conv_id"), key(F.col("url")).alias("key"))
    return table(spark, sf_dir, "conversations").join(pages, "conv_id").select("key", F.col("text").alias("raw"))


def one_answer_sql(key: str) -> str:
    """One raw answer per link: the longest, then the last, of the turns of all pages with it."""
    return f"""by_link AS (
      SELECT {key} AS key, c.text AS raw FROM conversations c JOIN pages p ON p.page_id = c.conv_id
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY coalesce(c.text, '') <> '' DESC, length(coalesce(c.text, '')) DESC, c.text DESC) = 1)"""


FUZZY_SQL = f"""CASE WHEN trim(coalesce(raw, '')) = '' OR starts_with(trim(raw), '(') OR contains(lower(raw), 'proporciona') THEN 'Corporate Reputation'
  ELSE CASE {' '.join(f"WHEN contains(regexp_replace(upper(trim(raw)), '[\"\'\'.,]', ' ', 'g'), '{a}') THEN '{c}'" for a, c in d.LABEL_ALIASES.items())}
    ELSE 'Corporate Reputation' END END"""


@query(
    with_views(
        ITEMS_SQL,
        OWN_SQL,
        one_answer_sql(suffix_sql("p.url", 2)),
        f"""judged AS (
      SELECT {suffix_sql('p.url', 2)} AS key, CASE WHEN l.toxic = 1 THEN ' Negativo' WHEN l.quality = 1 THEN 'positivo ' ELSE 'sin dato' END AS raw
      FROM labels l JOIN pages p ON p.page_id = l.doc_id // 4
      QUALIFY row_number() OVER (PARTITION BY {suffix_sql('p.url', 2)} ORDER BY length(CASE WHEN l.toxic = 1 THEN ' Negativo' WHEN l.quality = 1 THEN 'positivo ' ELSE 'sin dato' END) DESC,
        CASE WHEN l.toxic = 1 THEN ' Negativo' WHEN l.quality = 1 THEN 'positivo ' ELSE 'sin dato' END DESC) = 1)""",
    )
    + f"""
    SELECT h.link_key, h.title, (SELECT {FUZZY_SQL} FROM (SELECT max(raw) AS raw FROM by_link b WHERE b.key = c.link)) AS tag,
      CASE j.raw WHEN ' Negativo' THEN 'NEGATIVO' WHEN 'positivo ' THEN 'POSITIVO' ELSE 'NEUTRO' END AS sentiment
    FROM h JOIN c ON c.seq = h.seq LEFT JOIN judged j ON j.key = c.link WHERE h.link_key <> ''
    """
)
def own_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own feed from items to tagged and judged table rows, run twice."""
    target, cache = shared_dir(spark, "own"), shared_dir(spark, "own-cache")
    twice = lambda link: normalize_link_suffix(link, 2)
    judgement = F.when(F.col("toxic") == 1, " Negativo").when(F.col("quality") == 1, "positivo ").otherwise("sin dato")
    pages = table(spark, sf_dir, "pages").select("page_id", twice(F.col("url")).alias("key"))
    sentiments = table(spark, sf_dir, "labels").select(page_of(F.col("doc_id")).alias("page_id"), judgement.alias("raw")).join(pages, "page_id")
    feed, texts = item_log(spark, sf_dir).select(*LOG_COLUMNS), item_texts(spark, sf_dir)
    config = replace(OWN_FEED, pattern=RIVAL_PATTERN)
    labeller = classify.stored_labeller(stored_answers(spark, sf_dir, twice))
    for _run in range(2):
        jobs.own_job(feed, target, cache, labeller, sentiments.select("key", "raw"), TODAY, ["seq"], config, texts=texts)
    return read_target(spark, target, d.OWN_HEADER).select("link_key", "title", "tag", "sentiment")


CLIPPING_ROWS_SQL = (
    with_views(
        ITEMS_SQL,
        PARAGRAPHS_SQL,
        BODIES_SQL,
        one_answer_sql("trim(p.url)"),
        f"""
a AS ({first_sql('items', 'link')}),
b AS (SELECT a.*, coalesce(x.article_body, '') AS body FROM a LEFT JOIN bodies x ON x.url = trim(a.link) WHERE {RECENT_SQL}),
c AS MATERIALIZED (SELECT *, {fold_sql("title || ' ' || snippet || ' ' || body")} AS fo,
  {fold_sql("trim(title, chr(10) || ' ') || ' ' || trim(snippet, chr(10) || ' ') || ' ' || body")} AS ft FROM b),
d AS MATERIALIZED (SELECT * FROM c WHERE {any_term_sql('fo', INCLUDE)} AND NOT {any_term_sql('fo', EXCLUDE)}),
r AS MATERIALIZED (SELECT d.*, y.raw, {fold_sql("coalesce(y.raw, '')")} AS rf, {category_case_sql('ft', tuple(RULES), RULES)} AS rule FROM d LEFT JOIN by_link y ON y.key = trim(d.link)),
tagged AS MATERIALIZED (SELECT *, coalesce(rule, CASE WHEN starts_with(trim(coalesce(raw, '')), '(') OR starts_with(lower(trim(coalesce(raw, ''))), 'por favor')
    OR contains(lower(coalesce(raw, '')), 'proporciona la noticia') THEN {sql_list([d.CLIPPING_DEFAULT_CATEGORY])} END,
  {category_case_sql('rf', d.CATEGORIES, d.CATEGORY_TERMS)}, {sql_list([d.CLIPPING_DEFAULT_CATEGORY])}) AS tag FROM r),
e AS ({first_sql('tagged', 'link')}),
f AS ({first_sql('e', 'title, snippet')}),
g AS (SELECT *, trim(link) AS link_key FROM f),
h AS ({first_sql('g', 'link_key')})
""",
    )
)


def run_clipping_job(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The clipping feed's job over all items, run twice; the table's path and the distribution of the last run."""
    target, cache = shared_dir(spark, "clipping"), shared_dir(spark, "clipping-cache")
    bodies = table(spark, sf_dir, "pages").select(url_key(F.col("url")).alias("url_key"), body_text(F.col("html")).alias("article_body"))
    feed, texts = item_log(spark, sf_dir).select(*LOG_COLUMNS), item_texts(spark, sf_dir)
    labeller = classify.stored_labeller(stored_answers(spark, sf_dir, url_key))
    rules = lambda folded: labels.category_by_rules(folded, RULES, tuple(RULES))
    for _run in range(2):
        counts = jobs.clipping_job(feed, target, cache, bodies, labeller, TODAY, ["seq"], INCLUDE, EXCLUDE, rules, texts=texts)
    return target, counts


@query(CLIPPING_ROWS_SQL + "SELECT link_key, title, tag FROM h WHERE link_key <> ''")
def clipping_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clipping feed from items to tagged table rows."""
    target, _counts = run_clipping_job(spark, sf_dir)
    return read_target(spark, target, d.CLIPPING_HEADER).select("link_key", "title", "tag")


@query(CLIPPING_ROWS_SQL + "SELECT tag, count(*) AS n FROM h WHERE link_key <> '' GROUP BY tag")
def clipping_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of the day's rows in the clipping table."""
    return run_clipping_job(spark, sf_dir)[1]
