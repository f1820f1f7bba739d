"""Physical plans: what is pushed down, shuffled and broadcast."""

import io
from contextlib import redirect_stdout
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators import dedupe, digest, filters, joins, terms
from newsloom.plans.ingest import OWN_FEED, clean_feed
from newsloom.workload import QUERIES, digests
from newsloom.workload.digests import digest_rows
from newsloom.workload.ingestion import FEED_COLUMNS
from newsloom.workload.views import items, table
from settings import SF_DIR


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_dedupe_limits_groups_before_the_shuffle(spark):
    found = plan(dedupe.dedupe_by_link(spark.range(5).select(F.col("id"), F.concat(F.lit("k"), F.col("id") % 2).alias("link_key")), ["id"]))
    assert found.count("WindowGroupLimit") == 2 and "Partial" in found


def test_topic_leaders_limit_groups_before_the_shuffle(spark):
    assert "Partial" in plan(digest.topic_leaders(digest_rows(spark, SF_DIR)))


def test_only_new_is_an_anti_join(spark):
    left = spark.range(5).select(F.col("id").cast("string").alias("link_key"))
    assert "LeftAnti" in plan(joins.only_new(left, left))
    narrow = plan(joins.only_new(left, left, narrow=True))
    assert "LeftAnti" in narrow and "LeftSemi" in narrow


def test_term_match_has_no_nested_loop(spark):
    texts = table(spark, SF_DIR, "documents").select("doc_id", F.upper("text").alias("folded"))
    words = table(spark, SF_DIR, "benchmark").select(F.upper("text").alias("term"))
    found = plan(terms.term_match(texts, words, ["doc_id"]))
    assert "NestedLoop" not in found and "Cartesian" not in found


def test_window_reaches_the_scan(spark, tmp_path):
    items(spark, SF_DIR).select("seq", "scraped_ts").write.parquet(str(tmp_path / "t"))
    found = plan(filters.digest_window(spark.read.parquet(str(tmp_path / "t")), datetime(2024, 1, 8, 10)))
    assert "GreaterThanOrEqual(scraped_ts" in found and "LessThan(scraped_ts" in found


def test_scans_read_only_what_is_used(spark):
    found = plan(QUERIES["digest_slots"](spark, SF_DIR))
    assert "text:string" not in found and "html:string" not in found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"fold_text_exact", "sentiment"}))
def test_no_python_no_cross_join(spark, name):
    if name.startswith("stream_") or name == "feed_files":
        return
    found = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "InPandas", "NestedLoop", "CartesianProduct"):
        assert word not in found, word


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_text_is_shuffled_to_find_copies(spark):
    """Windows and their exchanges of a cleaned feed see keys, order and a hash, not the texts."""
    rows = items(spark, SF_DIR).select(*FEED_COLUMNS)
    found = executed(clean_feed(rows, replace(OWN_FEED, pattern="a"), date(2024, 1, 16), ["seq"]))
    windows = [line for line in found.splitlines() if "WindowGroupLimit" in line or "Window [" in line]
    assert windows and not any("snippet" in line or "title" in line for line in windows)
    sorts = [line for line in found.splitlines() if "Exchange hashpartitioning" in line]
    assert sorts and "_content" in "".join(sorts)


def test_texts_are_joined_to_placed_cards(spark, tmp_path):
    """Of a document that ten items show, the text goes to the cards' places once; documents with one number keep their own."""
    for name in ("events", "pages", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    other = documents.where("doc_id % 3 = 0").withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.lit("otro\ntexto")))
    documents.unionByName(other).unionByName(documents.where("doc_id % 5 = 0")).write.parquet(str(tmp_path / "documents.parquet"))
    made = digests.digest_fields(spark, str(tmp_path))
    shown = made.groupBy("title", "snippet").count().collect()
    rows = digests.digest_rows(spark, str(tmp_path)).where("NOT has_topic")
    expected = digest.card_fields(rows.withColumns({"position": F.lit(1), "also_in": F.lit("")})).groupBy("title", "snippet").count().collect()
    found = {(r["title"], r["snippet"]): r["count"] for r in shown}
    assert all(found.get((r["title"], r["snippet"]), 0) >= r["count"] for r in expected) and expected
