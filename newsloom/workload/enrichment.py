"""Bodies, caches, classification and task lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions import labels
from newsloom.functions.html import body_text
from newsloom.functions.links import url_key
from newsloom.functions.text import parse_list
from newsloom.operators import joins
from newsloom.plans.classify import classify as classify_rows, classify_sentiment, stored_labeller
from newsloom.session import shared_dir
from newsloom.sources import lookups
from newsloom.workload.cleaning import PARAGRAPHS_SQL, TEXT_CATEGORIES, category_case_sql, sql_list
from newsloom.workload.registry import query
from newsloom.workload.views import ARTICLES_SQL, articles, fold_sql, page_of, table, with_views

# The rule for bodies: pieces between tags are trimmed, blank ones go, the rest is joined by blanks.
BODIES_SQL = r"""
bodies AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(raw, lambda p: array_to_string(list_filter(list_transform(
      string_split(regexp_replace(p, '<[^>]*>', chr(2), 'g'), chr(2)),
      lambda x: trim(replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), chr(10) || ' ')),
      lambda x: x <> ''), ' ')), lambda p: p <> ''), ' ') AS article_body
  FROM inner_parts
)
"""


@query(
    with_views(ARTICLES_SQL, PARAGRAPHS_SQL, BODIES_SQL)
    + "SELECT doc_id, link, coalesce(article_body, '') AS article_body FROM articles LEFT JOIN bodies ON url = link"
)
def attach_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with the text of their stored page."""
    pages = table(spark, sf_dir, "pages")
    bodies = pages.select(url_key(F.col("url")).alias("url_key"), body_text(F.col("html")).alias("article_body"))
    rows = articles(spark, sf_dir).withColumn("url_key", url_key(F.col("link")))
    return joins.attach_body(rows, bodies).select("doc_id", "link", "article_body")


CACHE_SQL = "CASE WHEN l.doc_id IS NOT NULL THEN CASE l.quality WHEN 1 THEN 'good' ELSE '' END"
LENGTH_CLASS_SQL = "CASE WHEN length(d.text) > 2000 THEN 'long' ELSE 'short' END"


def quality_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The editors' labels as a cache; poor texts have a blank entry."""
    value = F.when(F.col("quality") == 1, "good").otherwise("")
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"), value.alias("value"))


def keyed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), "text")


@query(
    f"""
    SELECT CAST(d.doc_id AS VARCHAR) AS key, l.doc_id IS NOT NULL AS cache_hit, {CACHE_SQL} ELSE {LENGTH_CLASS_SQL} END AS value
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """
)
def cached_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cached values first, computed ones for the rest."""
    computed = F.when(F.length("text") > 2000, "long").otherwise("short")
    rows = joins.cached_enrich(keyed_documents(spark, sf_dir), quality_cache(spark, sf_dir), "key", "value", computed)
    return rows.select("key", "cache_hit", "value")


@query(
    f"""
    SELECT CAST(d.doc_id AS VARCHAR) AS key, {LENGTH_CLASS_SQL} AS value
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.quality <> 1
    """
)
def cache_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run adds to the cache when blank entries are asked again."""
    computed = F.when(F.length("text") > 2000, "long").otherwise("short")
    rows = joins.cached_enrich(
        keyed_documents(spark, sf_dir), quality_cache(spark, sf_dir), "key", "value", computed, retry_blank=True
    )
    return joins.new_entries(rows, "key", "value")


@query(
    """
    WITH queries AS (
      SELECT conv_id, turn, trim(unnest(string_split(text, ',')), chr(10) || ' ') AS query FROM conversations)
    SELECT conv_id, turn, query, country, count(*) AS n
    FROM queries, (VALUES ('ar'), ('cl'), ('pe')) AS c(country) WHERE query <> '' GROUP BY ALL
    """
)
def task_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every query of a comma-separated list in every country."""
    config = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    countries = parse_list(F.lit("ar, cl,,pe,"))
    tasks = joins.task_matrix(parse_list(F.col("text")), countries, config)
    return tasks.groupBy("conv_id", "turn", "query", "country").agg(F.count(F.lit(1)).alias("n"))


# Raw answers: the longest turn of the conversation with the document's number.
RESPONSES_SQL = """
responses AS (
  SELECT CAST(conv_id AS VARCHAR) AS key, text AS raw FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(text, '') <> '' DESC, length(coalesce(text, '')) DESC, text DESC) = 1)
"""
RULES = {"Licencias": TEXT_CATEGORIES["Licencias"], "Häuser": TEXT_CATEGORIES["Häuser"]}


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("key"), F.col("text").alias("raw"))


@query(
    with_views(ARTICLES_SQL, RESPONSES_SQL)
    + f""", known AS MATERIALIZED (
      SELECT a.doc_id, CASE WHEN l.quality = 1 THEN 'good' WHEN l.doc_id IS NOT NULL THEN '' END AS cached,
        {fold_sql("a.text")} AS f, r.raw
      FROM articles a LEFT JOIN labels l USING (doc_id) LEFT JOIN responses r ON r.key = CAST(a.doc_id AS VARCHAR)),
    ruled AS MATERIALIZED (SELECT *, CASE WHEN cached IS NULL THEN {category_case_sql('f', tuple(RULES), RULES)} END AS rule,
      {fold_sql("coalesce(raw, '')")} AS rf FROM known)
    SELECT doc_id, CASE WHEN cached IS NOT NULL THEN 'cache' WHEN rule IS NOT NULL THEN 'rules' ELSE 'labeller' END
        AS tag_origin,
      coalesce(cached, rule, CASE WHEN starts_with(trim(coalesce(raw, '')), '(')
          OR starts_with(lower(trim(coalesce(raw, ''))), 'por favor')
          OR contains(lower(coalesce(raw, '')), 'proporciona la noticia') THEN {sql_list([d.CLIPPING_DEFAULT_CATEGORY])} END,
        {category_case_sql('rf', d.CATEGORIES, d.CATEGORY_TERMS)}, {sql_list([d.CLIPPING_DEFAULT_CATEGORY])}) AS tag
    FROM ruled
    """
)
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache, rules and stored answers over the whole articles."""
    rows = articles(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("url_key"), "title", "snippet")
    rows = rows.withColumn("article_body", F.lit(""))
    tagged = classify_rows(
        rows,
        quality_cache(spark, sf_dir),
        stored_labeller(responses(spark, sf_dir)),
        rules=lambda folded: labels.category_by_rules(folded, RULES, tuple(RULES)),
    )
    return tagged.select("doc_id", "tag_origin", "tag")


@query(
    with_views(PARAGRAPHS_SQL)
    + """, texts AS (SELECT page_id, url, array_to_string(ps, ' ') AS body FROM paragraphs),
    answers AS (
      SELECT p.url, CASE WHEN l.toxic = 1 THEN ' Negativo' WHEN l.quality = 1 THEN 'positivo ' ELSE 'sin dato' END AS raw
      FROM labels l JOIN pages p ON p.page_id = l.doc_id // 4),
    one AS (SELECT * FROM answers QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(raw) DESC, raw DESC) = 1)
    SELECT t.url, CASE WHEN t.body = '' THEN 'NEUTRO' WHEN o.raw = ' Negativo' THEN 'NEGATIVO' WHEN o.raw = 'positivo ' THEN 'POSITIVO'
      ELSE 'NEUTRO' END AS sentiment
    FROM texts t LEFT JOIN one o ON o.url = t.url
    """
)
def sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page sentiment from stored answers: the editors' judgement of the page's documents, as text."""
    pages = table(spark, sf_dir, "pages")
    raw = F.when(F.col("toxic") == 1, " Negativo").when(F.col("quality") == 1, "positivo ").otherwise("sin dato")
    judged = table(spark, sf_dir, "labels").select(page_of(F.col("doc_id")).alias("page_id"), raw.alias("raw"))
    answers = judged.join(pages.select("page_id", F.col("url").alias("key")), "page_id").select("key", "raw")
    return classify_sentiment(pages, stored_labeller(answers), "la marca").select("url", "sentiment")


@query(
    f"""
    SELECT CAST(d.doc_id AS VARCHAR) AS key, true AS cache_hit, CASE WHEN l.quality = 1 THEN 'good' ELSE {LENGTH_CLASS_SQL} END AS value
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """
)
def cache_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache on disk: saved twice over, used with blanks asked again, added to, compacted, and read by a second run."""
    path = shared_dir(spark, "cache")
    labels_cache, documents = quality_cache(spark, sf_dir), keyed_documents(spark, sf_dir)
    computed = F.when(F.length("text") > 2000, "long").otherwise("short")
    for _copy in range(2):
        lookups.save_lookup(labels_cache, path)

    def run() -> DataFrame:
        return joins.cached_enrich(documents, lookups.load_lookup(spark, path), "key", "value", computed, retry_blank=True)

    lookups.save_lookup(joins.new_entries(run(), "key", "value"), path)
    lookups.compact_lookup(spark, path)
    return run().select("key", "cache_hit", "value")
