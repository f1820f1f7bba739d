"""Whole ingestion runs against a table on disk, and streams against their batch form."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.links import strip_query_fragment
from newsloom.operators.dedupe import dedupe_by_link
from newsloom.operators.filters import has_key, relevance
from newsloom.functions.dates import window_bounds
from newsloom.plans.digest import cards, documents, table_rows
from newsloom.plans.ingest import CLIPPING_FEED, COMPETITOR_FEED, OWN_FEED, clean_feed, ingest, new_rows
from newsloom.sources.feeds import read_feed, stream_feed
from newsloom.sources.tables import append_new, read_target
from newsloom.streaming.append import append_batch, incremental_append
from newsloom.streaming.windows import dedupe_stream, digest_windows, first_in_order, first_of_periods

TODAY = date(2026, 1, 6)


def entry(link, title="TikTok hoy", snippet="s", date_utc="2026-01-06T12:00:00Z", **more):
    return {
        "link": link, "title": title, "snippet": snippet, "date_utc": date_utc, "domain": "d", "source": "m", "country": "ar",
        "query": "tiktok", "scraped_at": "2026-01-06T10:20:30-03:00", **more,
    }


@pytest.fixture
def feed(spark, tmp_path):
    def make(*entries):
        path = tmp_path / f"feed-{len(list(tmp_path.iterdir()))}"
        path.mkdir()
        lines = [json.dumps({**e, "n": i}, ensure_ascii=False) for i, e in enumerate(entries)]
        (path / "items.json").write_text("\n".join(lines), encoding="utf-8")
        schema = read_feed(spark, str(path)).schema.add("n", "long")
        return read_feed(spark, str(path), schema=schema)

    return make


def links(spark, path):
    return sorted(r.link for r in spark.read.parquet(path).collect())


def test_own_feed(spark, feed, tmp_path):
    path = str(tmp_path / "own")
    first = feed(
        entry("http://x/a/amp/"),
        entry("http://x/a", title="TikTok copia"),
        entry("http://x/b?outputType=amp", snippet="otro"),
        entry("http://x/c", title="otra cosa", snippet="redes sociales"),
        entry("http://x/d", title="nada"),
        entry("http://x/e", date_utc="2026-01-04T12:00:00Z"),
        entry("http://x/f", date_utc="ayer"),
        entry("http://x/g", title="TikTok hoy"),  # same title and snippet as the first one
        entry(None, title="TikTok sin link", snippet="u"),
    )
    ingest(first, path, OWN_FEED, TODAY, ["n"], max_records=1)
    assert links(spark, path) == ["http://x/a", "http://x/b", "http://x/c"]
    row = spark.read.parquet(path).where("link = 'http://x/a'").first()
    assert (row.title, row.country, row.date_utc, row.scraped_at, row.tier) == ("TikTok hoy", "Argentina", "06/01/2026", "06/01/2026 10:20", "")
    assert [c for c in spark.read.parquet(path).columns if c != "ingest_day"] == [*d.OWN_HEADER, "link_key"]
    assert len(list((tmp_path / "own").rglob("*.parquet"))) == 3
    ingest(first, path, OWN_FEED, TODAY, ["n"])
    assert len(links(spark, path)) == 3
    ingest(feed(entry("http://x/a.amp", title="TikTok nuevo"), entry("http://x/z", title="tik tok z")), path, OWN_FEED, TODAY, ["n"])
    assert links(spark, path) == ["http://x/a", "http://x/b", "http://x/c", "http://x/z"]
    recent = read_target(spark, path, d.OWN_HEADER, since=date(2026, 1, 7))
    assert recent.count() == 0


def test_resolved_redirects(spark, feed):
    resolved = spark.createDataFrame([("AB", "http://t/a/amp")], "article_id string, resolved string")
    found = clean_feed(
        feed(entry("https://news.google.com/rss/articles/AB?x"), entry("https://news.google.com/rss/articles/ZZ?x", title="TikTok 2")),
        OWN_FEED, TODAY, ["n"], resolved,
    )
    assert sorted(r.link for r in found.collect()) == ["http://t/a", "https://news.google.com/rss/articles/ZZ?x"]


def test_clipping_feed(spark, feed):
    rows = feed(
        entry(" http://x/a/ ", title="RIGI avanza", country="ar"),
        entry("http://x/b", title="BHP y messi"),
        entry("http://x/c", title="RIGI en Chile", country="cl", snippet="t"),
    )
    clean = clean_feed(rows, CLIPPING_FEED, TODAY, ["n"], refine=relevance)
    target = spark.createDataFrame([("http://x/z",)], "link_key string")
    found = {r.link_key: r for r in new_rows(clean, target, CLIPPING_FEED).collect()}
    assert set(found) == {"http://x/a/", "http://x/c"}
    assert found["http://x/a/"].link == " http://x/a/ " and found["http://x/c"].country == "cl"
    assert found["http://x/a/"].country == "Argentina"


def test_competitor_feed(spark, feed):
    rows = feed(
        entry("http://x/a/?q=1", title="YouTube y más", date_utc="2020-01-01T00:00:00Z"),
        entry("http://x/a#z", title="Roblox"),
        entry("http://x/b", title="None", snippet="facebook"),
        entry("http://x/c", title="nada"),
    )
    clean = clean_feed(rows, COMPETITOR_FEED, TODAY, ["n"])
    found = {r.link: r for r in new_rows(clean, spark.createDataFrame([], "link_key string"), COMPETITOR_FEED).collect()}
    assert set(found) == {"http://x/a", "http://x/b"}
    assert found["http://x/a"].title == "YouTube y más" and found["http://x/a"].date_utc == "31/12/2019"
    assert found["http://x/b"].title == "None"
    assert list(next(iter(found.values())).asDict()) == [*d.COMPETITOR_HEADER, "link_key"]


def test_stream_append_replays(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    header = ("link",)

    def clean(batch):
        return dedupe_by_link(has_key(batch.withColumn("link_key", strip_query_fragment(F.col("link")))), ["link"])

    body = append_batch(clean, path, header, lambda: TODAY)
    state = str(tmp_path / "state")
    for number, found in enumerate([["http://x/a", "http://x/a?b"], ["http://x/a#c", "http://x/d"]]):
        (source / f"{number}.json").write_text("\n".join(json.dumps({"link": u}) for u in found))
        incremental_append(stream_feed(spark, str(source)), body, state).awaitTermination()
    assert links(spark, path) == ["http://x/a", "http://x/d"]
    body(read_feed(spark, str(source)), 7)
    assert links(spark, path) == ["http://x/a", "http://x/d"]


def test_stream_windows_and_dedupe(spark, tmp_path):
    source = tmp_path / "ev"
    stamps = [("a", 1, 11), ("a", 1, 13), ("b", 2, 11), ("a", 2, 13), ("c", 5, 13)]
    df = spark.createDataFrame([(k, datetime(2024, 1, day, hour)) for k, day, hour in stamps], "k string, ts timestamp")
    df.coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema(df.schema).parquet(str(source))

    def run(result, name):
        out = str(tmp_path / name)
        writer = result.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state")
        writer.trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(out)

    counts = run(digest_windows(stream, "ts", ["k"]), "w")
    found = sorted((r.end.day, r.k, r.n) for r in counts.collect())
    assert found == [(1, "a", 1), (2, "a", 1), (2, "b", 1), (3, "a", 1)]
    once = run(dedupe_stream(stream, "k", "ts"), "d")
    assert sorted(r.k for r in once.collect()) == ["a", "b", "c"]


def test_append_to_an_empty_target(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_target(spark, path, ("link",)).columns == ["link", "link_key", "ingest_day"]
    append_new(spark.createDataFrame([("a", "k")], "link string, link_key string"), path, ("link",), TODAY)
    assert read_target(spark, path, ("link",), since=TODAY).count() == 1


def test_from_feeds_to_a_digest(spark, feed, tmp_path):
    own, rivals = str(tmp_path / "own"), str(tmp_path / "rivals")
    ingest(feed(entry("http://x/a"), entry("http://x/b", title="TikTok dos", country="pe")), own, OWN_FEED, TODAY, ["n"])
    ingest(feed(entry("http://y/a", title="YouTube"), entry("http://y/b", title="Roblox")), rivals, COMPETITOR_FEED, TODAY, ["n"])
    edited = spark.read.parquet(rivals).withColumn("enviar", F.when(F.col("title") == "Roblox", "Sí").otherwise(""))
    shown = cards(table_rows(spark.read.parquet(own)), table_rows(edited), datetime(2026, 1, 7, 8))
    found = sorted((r.block, r.country, r.title, r.sentiment) for r in shown.collect())
    assert found == [
        ("competitor", "Argentina", "Roblox", ""),
        ("own", "Argentina", "TikTok hoy", ""),
        ("own", "Peru", "TikTok dos", ""),
    ]
    assert cards(table_rows(spark.read.parquet(own)), table_rows(edited), datetime(2026, 1, 9, 8)).count() == 0


def test_order_may_name_header_columns(spark, feed, tmp_path):
    """The published instant decides, although the table shows it as day, month, year."""
    path = str(tmp_path / "own")
    late = entry("http://x/a", title="TikTok tarde", date_utc="2026-01-06T12:00:00Z")
    early = entry("http://x/a", title="TikTok antes", date_utc="2026-01-05T12:00:00Z")
    ingest(feed(late, early), path, OWN_FEED, TODAY, ["date_utc", "link"])
    assert [r.title for r in spark.read.parquet(path).collect()] == ["TikTok antes"]


def test_first_run_without_rows_leaves_a_usable_table(spark, feed, tmp_path):
    path = str(tmp_path / "own")
    ingest(feed(entry("http://x/a", title="nada")), path, OWN_FEED, TODAY, ["n"])
    assert read_target(spark, path, d.OWN_HEADER).count() == 0
    ingest(feed(entry("http://x/a")), path, OWN_FEED, TODAY, ["n"])
    ingest(feed(entry("http://x/a/amp")), path, OWN_FEED, TODAY, ["n"])
    assert [r.link for r in read_target(spark, path, d.OWN_HEADER).collect()] == ["http://x/a"]


def test_a_table_without_keys_gets_them_from_its_links(spark, feed, tmp_path):
    """A table in header layout, spelled in capitals; its link is one canonical step behind."""
    path = str(tmp_path / "own")
    columns = [F.lit("http://x/a/").alias("LINK"), *[F.lit("").alias(c) for c in d.OWN_HEADER if c != "link"]]
    spark.range(1).select(*columns).withColumn("ingest_day", F.lit(TODAY)).write.partitionBy("ingest_day").parquet(path)
    ingest(feed(entry("http://x/a"), entry("http://x/b", title="TikTok b")), path, OWN_FEED, TODAY, ["n"])
    assert sorted(r.link for r in read_target(spark, path, d.OWN_HEADER).collect()) == ["http://x/a/", "http://x/b"]


@pytest.mark.parametrize("day", range(5, 12))
def test_digest_of_any_weekday_is_labelled_by_its_own_window(spark, day):
    """`now` from Friday 5 to Thursday 11 January 2024."""
    now = datetime(2024, 1, day, 10)
    window = window_bounds(now)
    stamps = [window.start - timedelta(minutes=1), window.start, window.end - timedelta(minutes=1), window.end]
    rows = [(s.strftime("%d/%m/%Y %H:%M"), "Argentina", f"topic {n}") for n, s in enumerate(stamps)]
    table = table_rows(spark.createDataFrame(rows, "scraped_at string, country string, tema string").withColumn("link", F.col("scraped_at")))
    shown = cards(table, table.where("false"), now)
    assert shown.count() == 2
    made = documents(shown).select("digest_day", "subject").distinct().collect()
    assert [r.digest_day for r in made] == [now.date()]
    assert window.label in made[0].subject


def test_a_table_under_its_own_header_keeps_it(spark, feed, tmp_path):
    """Every column is called otherwise; links are found by position and compared in canonical form."""
    path = str(tmp_path / "own")
    names = {name: f"c{n}" if name != "link" else "enlace" for n, name in enumerate(d.OWN_HEADER)}
    old = [F.lit("http://x/a/amp").alias("enlace") if n == "link" else F.lit("").alias(names[n]) for n in d.OWN_HEADER]
    spark.range(1).select(*old).withColumn("ingest_day", F.lit(TODAY)).write.partitionBy("ingest_day").parquet(path)
    for _ in range(2):
        ingest(feed(entry("http://x/a"), entry("http://x/b", title="TikTok b")), path, OWN_FEED, TODAY, ["n"])
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted(r.enlace for r in stored.collect()) == ["http://x/a/amp", "http://x/b"] and "link" not in stored.columns


def test_a_batch_reads_its_own_buckets(spark, feed, tmp_path):
    path = str(tmp_path / "own")
    first = feed(*[entry(f"http://x/{i}", title=f"TikTok {i}") for i in range(40)])
    for _ in range(2):
        ingest(first, path, OWN_FEED, TODAY, ["n"], buckets=8)
    assert spark.read.parquet(path).count() == 40
    batch = spark.createDataFrame([("http://x/1",)], "link_key string")
    found = read_target(spark, path, d.OWN_HEADER, buckets=8, batch=batch)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert 0 < found.count() < 40 and "http://x/1" in {r.link_key for r in found.collect()}


def test_the_first_row_in_order_survives_in_a_stream(spark, tmp_path):
    """Several files: a copy, a late row that comes before the first one, and a copy after the horizon."""
    path = str(tmp_path / "log")
    at = lambda day, hour, n: (datetime(2024, 1, day, hour), n)
    files = [
        [("a", *at(1, 12, 1)), ("a", *at(1, 13, 2)), ("b", *at(1, 10, 3)), (None, *at(1, 9, 4))],
        [("a", *at(1, 11, 5)), ("a", *at(2, 1, 6)), ("b", *at(3, 9, 7))],
        [("a", *at(4, 12, 8)), ("b", *at(3, 10, 9)), ("b", *at(3, 11, 10)), ("c", *at(4, 0, 11)), ("c", *at(4, 0, 12))],
    ]
    schema = "k string, ts timestamp, n long"
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = stream_feed(spark, path, "parquet", spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1")
    out = str(tmp_path / "out")
    writer = first_in_order(stream, "k", ["ts", "n"]).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", out + "-state").trigger(availableNow=True).start().awaitTermination()
    found = first_of_periods(spark.read.parquet(out), "k", ["ts", "n"])
    assert sorted((r.k, r.n) for r in found.collect()) == [("a", 5), ("a", 8), ("b", 3), ("b", 9), ("c", 11)]


def test_texts_of_their_own_are_fetched_for_what_is_left(spark, monkeypatch):
    """Items that share texts: copies go by the narrow items, and only texts of the rows that are left are staged."""
    from newsloom.plans import ingest as module

    staged = []
    keep = module.with_row_ids

    def counted(rows):
        out = keep(rows)
        staged.append(out.count())
        return out

    monkeypatch.setattr(module, "with_row_ids", counted)
    log = [(n, f"http://x/{n % 4}/amp", n % 4, "2026-01-06T12:00:00Z") for n in range(400)] + [(400, None, 1, "2026-01-06T12:00:00Z"), (401, "http://x/9", 9, "2026-01-06T12:00:00Z")]
    log = spark.createDataFrame(log, "n long, link string, doc int, date_utc string")
    docs = [(0, "TikTok a", "s"), (0, "TikTok a", "s"), (1, "TikTok b", "s"), (2, "nada", "s"), (3, None, "TikTok d")]  # no text of item 9
    texts = spark.createDataFrame(docs, "doc int, title string, snippet string")
    for refine in (None, lambda rows: rows.withColumn("tag", F.lit("t"))):
        staged.clear()
        found = clean_feed(log, OWN_FEED, TODAY, ["n"], refine=refine, texts=texts)
        rows = sorted((r.link_key, r.title) for r in found.collect())
        assert max(staged) <= 6
        whole = clean_feed(log.join(texts, "doc").drop("doc"), OWN_FEED, TODAY, ["n"], refine=refine)
        assert rows == sorted((r.link_key, r.title) for r in whole.collect()) == [("http://x/0", "TikTok a"), ("http://x/1", "TikTok b"), ("http://x/3", None)]
