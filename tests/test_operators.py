"""Operators on small tables, against brute force where there is one."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom import dictionaries as d
from newsloom.functions.text import fold_text, shortest_terms
from newsloom.operators import columns, dedupe, digest, filters, joins, metrics, ranking, terms
from newsloom.operators.ranking import ordered_position
from newsloom.plans import classify
from newsloom.plans.digest import cards, documents
from newsloom.sources import lookups, sheets
from newsloom.sources.feeds import union_feeds


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ragged(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, ["a", "b", "c"]), (3, list("abcde"))], "n int, cells array<string>")
    assert rows(sheets.read_ragged(df, ["x", "y", "z"], keep=["n"])) == [(1, "a", "", ""), (2, "a", "b", "c"), (3, "a", "b", "c")]


def test_header_lookup(spark):
    assert sheets.resolve_key_column(["a", "link"], "link", d.OWN_HEADER) == "link"
    assert sheets.resolve_key_column(["a", "Link"], "link", d.OWN_HEADER) == "Link"
    assert sheets.resolve_key_column(["p", "q", "r"], "link", ["x", "link", "y"]) == "q"
    assert sheets.resolve_key_column(["p", "q"], "link", ["x", "link", "y"]) is None
    empty = sheets.key_column(spark.createDataFrame([("x",)], "p string"), "link", d.OWN_HEADER)
    assert empty.count() == 0


def test_columns(spark):
    df = spark.createDataFrame([(None, "x")], "a string, z string")
    assert rows(columns.conform(df, ["b", "a"])) == [("", None)]
    assert rows(columns.ensure_columns(df, ["a", "c"], fill_null=True)) == [("", "x", "")]


def test_union_aligns_columns(spark):
    left, right = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([("y", 2)], "c string, a int")
    assert set(map(tuple, union_feeds([left, right]).collect())) == {(1, "x", None), (2, None, "y")}


def test_dedupe_does_not_depend_on_row_order(spark):
    data = [(i, f"k{i % 7}", f"t{i % 5}", f"s{i % 3}") for i in range(60)] + [(60, "", "t", "s"), (61, None, "t", "s")]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "seq int, link_key string, title string, snippet string").repartition(3 + seed)
        one = dedupe.dedupe_by_link(df, ["seq"])
        results.add((tuple(rows(one.select("seq").coalesce(1))), tuple(rows(dedupe.dedupe_by_content(df, ["seq"]).select("seq")))))
    assert len(results) == 1
    by_link, by_content = results.pop()
    assert [s for (s,) in by_link] == [0, 1, 2, 3, 4, 5, 6, 60, 61]
    assert [s for (s,) in by_content] == list(range(15)) + [60]


def test_source_cap(spark):
    df = spark.createDataFrame([(i, "q", "c" if i % 2 else "d") for i in range(20)], "seq int, query string, country string")
    assert dedupe.source_cap(df, ["seq"], 3).count() == 6
    for wrong in (0, -1, "7", None, True, 2.5):
        with pytest.raises(ValueError):
            dedupe.source_cap(df, ["seq"], wrong)


@pytest.mark.parametrize("narrow", [False, True])
def test_only_new(spark, narrow):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n int, link_key string")
    existing = spark.createDataFrame([("b",), ("b",), ("z",), (None,)], "link_key string")
    assert rows(joins.only_new(df, existing, narrow=narrow).select("n", "link_key")) == [(1, "a"), (3, "c")]


@pytest.mark.parametrize("salts", [1, 5])
def test_bodies_for_a_hot_link(spark, salts):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)], "n int, url_key string")
    bodies = spark.createDataFrame([("hot", "H"), ("k3", "three")], "url_key string, article_body string")
    found = joins.attach_body(df, bodies, salts=salts)
    assert rows(found.groupBy("article_body").count()) == [("", 29), ("H", 60), ("three", 1)]


def test_cache_and_its_additions(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("", 3), ("c", 4)], "key string, n int")
    cache = spark.createDataFrame([("a", "A"), ("b", ""), ("", "never")], "key string, value string")
    found = joins.cached_enrich(df, cache, "key", "value", F.concat(F.lit("n"), "n"))
    assert rows(found.select("n", "value", "cache_hit")) == [(1, "A", True), (2, "", True), (3, "n3", False), (4, "n4", False)]
    assert rows(joins.new_entries(found, "key", "value")) == [("c", "n4")]
    retried = joins.cached_enrich(df, cache, "key", "value", F.concat(F.lit("n"), "n"), retry_blank=True)
    assert rows(joins.new_entries(retried, "key", "value")) == [("b", "n2"), ("c", "n4")]


def test_caches_and_bodies_never_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, n int")
    cache = spark.createDataFrame([("a", ""), ("a", "A"), ("b", ""), ("b", "")], "key string, value string")
    found = joins.cached_enrich(df, cache, "key", "value", F.lit("new"))
    assert rows(found.select("n", "value")) == [(1, "A"), (2, "A"), (3, "")]
    stamped = cache.withColumn("written_at", F.when(F.col("value") == "", "2024-01-02").otherwise("2024-01-01").cast("timestamp"))
    assert rows(joins.cached_enrich(df, stamped, "key", "value", F.lit("new")).select("n", "value")) == [(1, ""), (2, ""), (3, "")]
    bodies = spark.createDataFrame([("a", "short"), ("a", "the longer"), ("a", None)], "url_key string, article_body string")
    assert rows(joins.attach_body(df.withColumnRenamed("key", "url_key"), bodies).select("n", "article_body")) == [(1, "the longer"), (2, "the longer"), (3, "")]


def test_cache_files(spark, tmp_path):
    path = str(tmp_path / "cache")
    assert lookups.load_lookup(spark, path).count() == 0
    lookups.save_lookup(spark.createDataFrame([("a", "1")], "key string, value string"), path)
    lookups.save_lookup(spark.createDataFrame([("b", "2")], "key string, value string"), path)
    assert rows(lookups.load_lookup(spark, path)) == [("a", "1"), ("b", "2")]
    lookups.save_lookup(spark.createDataFrame([("a", "3")], "key string, value string"), path)
    assert rows(lookups.load_lookup(spark, path)) == [("a", "3"), ("b", "2")]
    left = [lookups.compact_lookup(spark, path) for _ in range(2)]
    assert left == [path, f"{path}-1"] and rows(lookups.load_lookup(spark, path)) == [("a", "3"), ("b", "2")]
    assert spark.read.parquet(f"{path}-2").count() == 2
    lookups.save_lookup(spark.createDataFrame([("b", ""), ("c", "4")], "key string, value string"), path)
    assert rows(lookups.load_lookup(spark, path)) == [("a", "3"), ("b", ""), ("c", "4")]
    raw = spark.createDataFrame([('{"u": "x", "v": "y"}',), ("{}",), ("bad",), (None,)], "j string")
    assert rows(lookups.json_lookup(raw, "j")) == [("u", "x"), ("v", "y")]


def test_resolved_links(spark):
    links = ["https://news.google.com/articles/A1?x", "https://g/goto?url=B2", "https://news.google.com/x", "https://ok/a", None]
    df = spark.createDataFrame(list(enumerate(links)), "n int, link string")
    resolved = spark.createDataFrame([("A1", "https://t/a"), ("A1", "https://t/a"), ("B2", None)], "article_id string, resolved string")
    expected = ["https://t/a", links[1], links[2], links[3], None]
    found = {r.n: r.link for r in joins.resolve_links(df, resolved).collect()}
    assert found == {n: link for n, link in enumerate(expected) if n != 4} | ({4: None} if 4 in found else {})
    assert len(found) == 5


def test_task_matrix(spark):
    df = spark.createDataFrame([(["a", "b"], ["x", "y"])], "q array<string>, c array<string>")
    tasks = joins.task_matrix(F.col("q"), F.col("c"), df).select("query", "country")
    assert rows(tasks) == sorted(itertools.product("ab", "xy"))


def test_term_match_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(40)})
    df = spark.createDataFrame(list(enumerate(texts)), "n int, folded string")
    table = spark.createDataFrame([(w,) for w in words] + [("",)], "term string")
    expected = sorted((n, w) for n, t in enumerate(texts) for w in words if w in t)
    assert rows(terms.term_match(df, table, ["n"])) == expected
    kinds = table.withColumn("kind", F.lit("a")).unionByName(table.withColumn("kind", F.lit("b")))
    both = terms.term_match(df, kinds, ["n"]).select("n", "term", "kind")
    assert rows(both) == sorted((n, w, k) for n, w in expected for k in "ab")
    hit = {n for n, _ in expected}
    assert {r.n for r in terms.texts_with_terms(df, table, ["n"]).collect()} == hit
    assert {r.n for r in terms.texts_without_terms(df, table, ["n"]).collect()} == set(range(80)) - hit
    assert terms.term_match(df, table.where("term = ''"), ["n"]).count() == 0


def test_term_match_writes_each_text_once(spark, monkeypatch):
    """The words of a text lie in one row, and nothing but what joins need is written beside them."""
    made = {}
    monkeypatch.setattr(terms, "written", lambda found, purpose, f=terms.written: made.update({purpose: f(found, purpose)}) or made[purpose])
    df = spark.createDataFrame([(1, "ABCDE FGHIJ ABCDE"), (2, "XABCDEX"), (3, None), (4, "")], "n int, folded string")
    table = spark.createDataFrame([("BCDE",), ("E F",), ("AB",), ("",)], "term string")
    assert rows(terms.term_match(df, table, ["n"])) == [(1, "AB"), (1, "BCDE"), (1, "E F"), (2, "AB"), (2, "BCDE")]
    assert sorted(r.n for r in made["texts"].collect()) == [1, 2, 3, 4]


def test_relevance(spark):
    data = [(1, "Vicuña Corp crece", None), (2, "Benjamin Vicuña y BHP", ""), (3, "nada", "RIGI"), (4, None, None)]
    df = spark.createDataFrame(data, "n int, title string, snippet string")
    assert [r.n for r in filters.relevance(df).orderBy("n").collect()] == [1, 3]
    words = [(1, "ORIGINAL"), (2, "el rigi.")]
    df = spark.createDataFrame(words, "n int, title string")
    assert [r.n for r in filters.relevance(df, whole_word=True).collect()] == [2]


def test_every_spelling_is_searched_once():
    folded = {fold_text(t) for t in d.INCLUDE_TERMS}
    assert len(folded) < len(d.INCLUDE_TERMS)
    needed = shortest_terms(d.INCLUDE_TERMS)
    assert len(needed) == len(set(needed)) and set(needed) <= folded


def test_window_and_flag_filters(spark):
    stamps = [datetime(2024, 1, 5, 8, 59), datetime(2024, 1, 5, 9), datetime(2024, 1, 8, 8, 59), datetime(2024, 1, 8, 9), None]
    df = spark.createDataFrame(list(enumerate(stamps)), "n int, scraped_ts timestamp")
    assert [r.n for r in filters.digest_window(df, datetime(2024, 1, 8, 10)).collect()] == [1, 2]
    assert filters.flagged(df).count() == 5
    days = spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 1, 6),), (date(2024, 1, 5),), (None,)], "published_day date")
    assert filters.recent_days(days, date(2024, 1, 7)).count() == 2


def test_hot_keys_are_dealt_to_many_tasks(spark):
    """Half of all rows have one key; the tasks that join get about alike many."""
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, "").otherwise(F.col("id").cast("string")).alias("url_key"), "id")
    table = df.select("url_key", F.concat(F.lit("body "), "url_key").alias("article_body")).distinct()
    hot = joins.hot_keys(df, "url_key")
    assert hot == ["hot"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.attach_body(df, table)
        keyed = found.where("url_key <> ''").withColumn("part", F.spark_partition_id())
        sizes = sorted(r["count"] for r in keyed.groupBy("part").count().collect())
        assert sizes[-1] <= 4 * sizes[len(sizes) // 2], sizes
        assert found.count() == 40_000 and found.where("url_key <> '' AND article_body <> concat('body ', url_key)").isEmpty()
        assert found.where("url_key = '' AND article_body <> ''").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_high_caps_sort_no_whole_source(spark):
    df = spark.range(9000).select((F.col("id") % 3 == 0).cast("string").alias("query"), F.lit("ar").alias("country"), (F.col("id") % 2500).alias("seq"), "id")
    capped = dedupe.source_cap(df, ["seq", "id"], 5000)
    plain = dedupe.first_rows(df, ["query", "country"], ["seq", "id"], 5000)
    assert rows(capped.select("query", "id")) == rows(plain.select("query", "id"))
    tied = dedupe.source_cap(df, ["seq"], 5000)
    assert rows(tied.groupBy("query").count()) == [("false", 5000), ("true", 3000)]
    assert capped.columns == df.columns


def test_positions_of_rows_with_one_stamp_are_dealt_to_many_tasks(spark, monkeypatch):
    """Every row has the same group and stamp; the number alone orders them, and no task has them all."""
    df = spark.range(40_000).select(F.lit("g").alias("g"), F.lit("2024-01-05").alias("stamp"), F.col("id").alias("seq"), F.repeat(F.lit("t"), 50).alias("snippet"))
    staged, plain = [], ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda rows: staged.append(plain(rows)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more rows than a task's share
    try:
        placed = ordered_position(df, ["g"], ["stamp"], ["seq"], "pos")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.where("pos <> seq + 1").isEmpty() and placed.count() == 40_000
    assert "snippet" not in staged[0].columns
    sizes = [r["count"] for r in staged[0].groupBy(F.shiftright("_row", 33)).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 15_000


def test_content_hash_tells_texts_and_nulls_apart(spark):
    data = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("", ""), ("1:a", "b"), ("a,1:b", None), ("a", "b")]
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(data)], "title string, snippet string, n int")
    assert [r.n for r in dedupe.dedupe_by_content(df, ["n"]).orderBy("n").collect()] == list(range(9))


def test_positions_equal_a_plain_window(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randint(0, 3), rng.randint(0, 2), i) for i in range(300)]
    df = spark.createDataFrame(data, "g string, x int, y int, i int")
    placed = ordered_position(df, ["g"], ["x", "y"], ["i"], "pos")
    plain = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("x", "y", "i")))
    assert rows(placed.select("i", "pos")) == rows(plain.select("i", "pos"))


def test_funnel_and_observation(spark):
    df = spark.range(10)
    steps = {"even": F.col("id") % 2 == 0, "small": F.col("id") < 5, "null": F.lit(None).cast("boolean")}
    assert rows(metrics.funnel(df, steps)) == [(1, "even", 10, 5, 5), (2, "small", 5, 3, 2), (3, "null", 3, 0, 3)]
    watched, counters = metrics.observed(df, "steps", even=F.col("id") % 2 == 0)
    watched.count()
    assert counters.get == {"rows": 10, "even": 5}
    tags = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "tag string")
    assert [tuple(r) for r in metrics.category_distribution(tags).collect()] == [("b", 2), ("a", 1), ("c", 1)]


def item(seq, **values):
    base = dict(
        seq=seq, scraped_ts=datetime(2024, 1, 8, 12) + timedelta(minutes=seq), country="Chile", title=f"t{seq}", snippet="s",
        source=f"m{seq}", domain="d", link=f"http://x/{seq}", tag="tag", sentiment="positivo", tier="Tier 1", tema="",
        prioridad="", enviar="sí",
    )
    return {**base, **values}


SCHEMA = (
    "seq bigint, scraped_ts timestamp, country string, title string, snippet string, source string, domain string, "
    "link string, tag string, sentiment string, tier string, tema string, prioridad string, enviar string"
)


def table(spark, *found):
    return spark.createDataFrame([tuple(f[c.split()[0]] for c in SCHEMA.split(", ")) for f in found], SCHEMA)


def test_digest(spark):
    own = table(
        spark,
        item(1, tema="A", tier="Tier 3"),
        item(2, tema="A", tier="Tier 2", source=None),
        item(3, tema="A", tier="Tier 3", prioridad="x"),
        *[item(n, tema="A", tier="Tier 3") for n in range(4, 9)],
        item(10, tier="Tier 2"),
        item(11, tier=None),
        item(12, tier="Tier 1", sentiment="Negativo"),
        item(13, tema="B", tier="Tier 1", source=""),
        item(14, enviar="no"),
        item(15, country=None),
        item(16, country="Argentina", sentiment=None),
    )
    rivals = table(spark, item(20, sentiment="Negativo", tier="x"), item(21, tema="C"))
    shown = cards(own, rivals, datetime(2024, 1, 9, 10))
    found = [(r.block, r.country, r.position, r.title, r.media, r.also_in) for r in shown.collect()]
    also = "Tier 2:  | ".replace(" | ", "") + "<http://x/2>\nTier 3: m1 <http://x/1> | m4 <http://x/4> | m5 <http://x/5>"
    assert sorted(found) == sorted(
        [
            ("own", "Chile", 1, "t13", "d", ""),
            ("own", "Chile", 2, "t3", "m3", also.replace("Tier 2: <", "Tier 2:  <")),
            ("own", "Chile", 3, "t10", "m10", ""),
            ("own", "Chile", 4, "t11", "m11", ""),
            ("own", "Chile", 5, "t12", "m12", ""),
            ("own", "Argentina", 1, "t16", "m16", ""),
            ("competitor", "Chile", 1, "t21", "m21", ""),
            ("competitor", "Chile", 2, "t20", "m20", ""),
        ]
    )
    by_block = {(r.block, r.country): r for r in shown.orderBy("position").collect()}
    assert by_block["competitor", "Chile"].sentiment == "" and by_block["own", "Chile"].tag == "TAG"
    parts = documents(shown, cards_per_part=2).where("block = 'own' AND country = 'Chile'").orderBy("part").collect()
    assert [p.cards for p in parts] == [2, 2, 1]
    whole = "".join(p.document for p in parts)
    assert whole.startswith("Own — Chile 🇨🇱\n\nTAG\nt13\n") and whole.count("Own — Chile") == 1
    assert [whole.index(t) for t in ("\nt13\n", "\nt3\n", "\nt10\n", "\nt11\n", "\nt12\n")] == sorted(
        whole.index(t) for t in ("\nt13\n", "\nt3\n", "\nt10\n", "\nt11\n", "\nt12\n")
    )
    assert parts[0].subject == "Newsletter (08/01/2024 09:00 - 09/01/2024 09:00)"
    markup = documents(shown, html=True).where("block = 'competitor'").collect()[0].document
    assert markup.startswith("<h2>Competencia — Chile") and "Sentiment" not in markup


def test_digest_does_not_depend_on_row_order(spark):
    rng = random.Random(9)
    data = [
        item(n, tema=rng.choice(["", "A", "B"]), tier=rng.choice(["Tier 1", "Tier 2", "", None]), prioridad=rng.choice(["", "x"]))
        for n in range(60)
    ]
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        results.append(rows(cards(table(spark, *data), table(spark, *data[:0])).drop("digest_day")))
    assert results[0] == results[1]


def test_empty_digest(spark):
    assert cards(table(spark), table(spark)).count() == 0


def test_classification(spark):
    asked = spark.sparkContext.accumulator(0)

    def model(batches):
        for batch in batches:
            asked.add(len(batch))
            yield batch.assign(raw=["zoom mendoza" if "norte" in p else "(no sé)" for p in batch["prompt"]])[["key", "raw"]]

    data = [("k1", "RIGI", ""), ("k2", "algo del norte", ""), ("k3", "otro", ""), ("k4", "BHP", ""), ("", "x", "")]
    df = spark.createDataFrame([(k, t, s, "") for k, t, s in data], "url_key string, title string, snippet string, article_body string")
    cache = spark.createDataFrame([("k4", "cached")], "key string, value string")
    found = classify.classify(df, cache, classify.batch_labeller(model))
    assert rows(found.select("url_key", "tag", "tag_origin")) == [
        ("", "Minería en general", "labeller"),
        ("k1", "Contexto argentino", "rules"),
        ("k2", "Zoom Mendoza", "labeller"),
        ("k3", "Minería en general", "labeller"),
        ("k4", "cached", "cache"),
    ]
    assert asked.value == 2
    responses = spark.createDataFrame([("k2", "Product."), ("k3", "Proporciona")], "key string, raw string")
    own = classify.classify(
        df, cache, classify.stored_labeller(responses), rules=lambda c: F.lit(None).cast("string"), to_category=classify.own_category
    )
    assert {r.url_key: r.tag for r in own.collect()}["k2"] == "Product"


def test_page_sentiment(spark):
    pages = spark.createDataFrame([("a", "<p>x</p>"), ("b", "none"), ("c", "<p>y</p>")], "url string, html string")
    responses = spark.createDataFrame([("a", " positivo\n"), ("c", "muy bueno")], "key string, raw string")
    found = classify.classify_sentiment(pages, classify.stored_labeller(responses), "la marca")
    assert rows(found.select("url", "sentiment")) == [("a", "POSITIVO"), ("b", "NEUTRO"), ("c", "NEUTRO")]


def test_labels_are_stored_and_not_asked_again(spark, tmp_path):
    asked = []
    df = spark.createDataFrame(
        [("k1", "nada", 1), ("k1", "nada mas", 2), ("k2", "RIGI", 3), ("", "nada", 4)], "url_key string, title string, n int"
    ).withColumns({"snippet": F.lit(""), "article_body": F.lit("")})

    def labeller(asks):
        asked.append(sorted(r.prompt for r in asks.collect()))
        return asks.select("key", F.lit("Zoom Mendoza").alias("raw")).union(asks.select("key", F.lit("").alias("raw")))

    path = str(tmp_path / "tags")
    for run in range(2):
        found = classify.classify(df, lookups.load_lookup(spark, path), labeller, template="<{text}>", order=["n"])
        assert found.count() == 4
        lookups.save_lookup(classify.new_labels(found), path)
    assert asked == [["<nada  >"], []] or asked == [["<nada>"], []]
    assert rows(lookups.load_lookup(spark, path)) == [("k1", "Zoom Mendoza"), ("k2", "Contexto argentino")]


def test_sentiment_of_repeated_pages(spark):
    pages = spark.createDataFrame([("u", "<p>a<b>b</b></p>")] * 2 + [("v", "")], "url string, html string")
    answers = spark.createDataFrame([("u", "positivo"), ("u", "positivo")], "key string, raw string")
    found = classify.classify_sentiment(pages, classify.stored_labeller(answers), "x")
    assert rows(found.select("url", "sentiment")) == [("u", "POSITIVO"), ("u", "POSITIVO"), ("v", "NEUTRO")]
