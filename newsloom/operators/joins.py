"""Joins against keyed tables: new rows, bodies, caches, resolved links and task lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.links import article_id, is_unresolved
from newsloom.functions.text import text

#: A key with one in so many of all rows is hot, and dealt to as many tasks.
SALTS = 32
SKETCH_ITEMS = 10_000


def only_new(df: DataFrame, existing: DataFrame, key: str = "link_key", narrow: bool = False) -> DataFrame:
    """Rows whose key is not in `existing`.

    The keys are made distinct before they are shuffled, so a key that fills much of `existing`
    moves as one row per task; the anti join then uses the same distribution.
    With `narrow`, the target's keys are first cut down to those of the batch, so that a batch
    much smaller than the target is what moves (or is broadcast when its measured size allows)
    and the target's keys stay where they were read. `df` is then used twice: stage it before.
    """
    keys = existing.select(key)
    if narrow:
        keys = keys.join(df.select(key), key, "left_semi")
    keys = keys.distinct()
    return df.join(keys, key, "left_anti")


def hot_keys(df: DataFrame, key: str, salts: int = SALTS) -> list[str]:
    """The keys that hold at least one in `salts` of all rows, from a sketch of the commonest ones.

    The sketch is merged from one of bounded size per task, and no more than `salts` keys can be hot, so
    what reaches the driver is bounded, too. Empty keys are left out.
    """
    keys = df.select(text(F.col(key)).alias("key")).where("key <> ''")
    found = keys.agg(F.expr(f"approx_top_k(key, {salts}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(item["item"] for item in found["top"] or [] if salts > 1 and item["count"] * salts >= found["n"])


def with_lookup(
    df: DataFrame, table: DataFrame, key: str, value: str, long_values: bool = False, salts: int = SALTS, hot: Sequence[str] | None = None
) -> DataFrame:
    """Left join on a table with one row per key.

    Rows without a key stay out of the join. The hot keys, those of `hot_keys` unless they are given, are
    dealt to `salts` tasks each, and their row of the table is repeated for these; all others are joined
    as they are. Tables with `long_values` are never broadcast, as Spark underestimates the size of
    computed texts.
    """
    hot = hot_keys(df, key, salts) if hot is None else hot
    filled = text(F.col(key)) != ""
    none = df.where(~filled).withColumn(value, F.lit(None).cast(table.schema[value].dataType))
    rows, side, on = df.where(filled), table.where(filled).select(F.col(key), F.col(value)), [key]
    if hot:
        is_hot = F.col(key).cast("string").isin(list(hot))
        mixed = F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()])
        rows = rows.withColumn("_salt", F.when(is_hot, F.pmod(mixed, F.lit(salts)).cast("int")).otherwise(F.lit(0)))
        side = side.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
        on = [key, "_salt"]
    return rows.join(side.hint("merge") if long_values else side, on, "left").drop("_salt").unionByName(none)


def one_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key: the newest by `written_at` where the table has it, filled before blank, then the longest value.

    Partial aggregation limits a key that many rows share before the shuffle, which the join that
    follows uses again.
    """
    filled = text(F.col(value))
    rank = [filled != "", F.length(filled), filled]
    if "written_at" in table.columns:
        rank.insert(0, F.coalesce(F.col("written_at").cast("timestamp"), F.lit("1970-01-01").cast("timestamp")))
    return table.groupBy(key).agg(F.max_by(F.col(value), F.struct(*rank)).alias(value))


def attach_body(df: DataFrame, bodies: DataFrame, key: str = "url_key", body: str = "article_body", salts: int = SALTS) -> DataFrame:
    """The body by url key; links without one get the empty text. The rows' keys are read twice."""
    one = one_per_key(bodies, key, body)
    return with_lookup(df.drop(body), one, key, body, long_values=True, salts=salts).withColumn(body, text(F.col(body)))


def cached_enrich(
    df: DataFrame, cache: DataFrame, key: str, value: str, computed: Column, retry_blank: bool = False
) -> DataFrame:
    """`value` from the cache where there is an entry, else from `computed`.

    Adds `cache_hit`. The expression is only evaluated for misses. Rows with an empty key never
    hit. A blank cached value counts as an entry unless `retry_blank`. Of several entries of a key
    one is used (`one_per_key`), so a cache never multiplies rows.
    """
    entries = one_per_key(cache.where(F.col(key) != ""), key, value)
    if retry_blank:
        entries = entries.where(text(F.col(value)) != "")
    joined = with_lookup(df.drop(value), entries.select(F.col(key), F.struct(F.col(value).alias("value")).alias("_cached")), key, "_cached")
    hit = F.col("_cached").isNotNull()
    return joined.withColumns({"cache_hit": hit, value: F.when(hit, F.col("_cached.value")).otherwise(computed)}).drop("_cached")


def new_entries(enriched: DataFrame, key: str, value: str) -> DataFrame:
    """What `cached_enrich` computed, one row per key, ready to be appended to the cache."""
    misses = enriched.where(~F.col("cache_hit") & (text(F.col(key)) != ""))
    return misses.groupBy(key).agg(F.min(value).alias(value))


def resolve_links(df: DataFrame, resolved: DataFrame, link: str = "link") -> DataFrame:
    """Replace redirects by their resolved url; redirects without one stay as they are.

    Only the unresolved rows are joined, so the large resolved majority is not shuffled.
    """
    target = resolved.groupBy("article_id").agg(F.min("resolved").alias("_resolved"))
    waiting = is_unresolved(F.col(link))
    done = df.where(~waiting)
    fixed = (
        df.where(waiting)
        .withColumn("_id", article_id(F.col(link)))
        .join(target.withColumnRenamed("article_id", "_id"), "_id", "left")
        .withColumn(link, F.coalesce(F.col("_resolved"), F.col(link)))
        .select(*df.columns)
    )
    return done.unionByName(fixed)


def task_matrix(queries: Column, countries: Column, df: DataFrame) -> DataFrame:
    """Every query in every country of a configuration row, without joining tables."""
    return df.withColumn("query", F.explode(queries)).withColumn("country", F.explode(countries))
