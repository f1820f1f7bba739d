"""Column functions on hand-written values."""

import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType

from newsloom import dictionaries as d
from newsloom.functions import cells, dates, html, labels, links, text
from newsloom.operators import columns, digest, filters


def values(spark, inputs, expression, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "passes, expected",
    [
        (1, ["http://x/a", "http://x/a/", "http://x/a?outputType", "http://x/a", "http://x/a", "http://x/a/amp", "http://x/a?b", "http://x/a", ""]),
        (3, ["http://x/a", "http://x/a", "http://x/a", "http://x/a", "http://x/a", "http://x/a", "http://x/a?b", "http://x/a", ""]),
    ],
)
def test_link_suffix(spark, passes, expected):
    urls = [
        "http://x/a/amp/", "http://x/a//", "http://x/a?outputType=amp", "http://x/a?outputType=amp-type", "http://x/a.amp",
        "http://x/a/amp/amp/", "http://x/a?b=amp", "  http://x/a/ ", None,
    ]
    assert values(spark, urls, lambda c: links.normalize_link_suffix(c, passes)) == expected


def test_link_cut(spark):
    urls = ["http://x/a//?b=1#c", "http://x/#t", "", None]
    assert values(spark, urls, links.strip_query_fragment) == ["http://x/a", "http://x", "", ""]


def test_link_cut_is_idempotent(spark):
    urls = ["http://x/a//?b=1#c", "http://x/#t?", "x?/", "https://a.b/c/"]
    once = values(spark, urls, links.strip_query_fragment)
    assert values(spark, once, links.strip_query_fragment) == once


def test_redirects(spark):
    found = ["https://news.google.com/rss/articles/AB1?x=2", "https://g/goto?url=CD2&k=1", "https://g/a", "", None]
    assert values(spark, found, links.is_unresolved) == [True, True, False, False, False]
    assert values(spark, found, links.article_id) == ["AB1", "CD2", None, None, None]
    responses = ['x["garturlres","http://t/a",1]', "nothing", '["garturlres","",1]']
    assert values(spark, responses, links.extract_resolved_url) == ["http://t/a", None, None]
    pages = ['<a data-n-a-sg="S" data-n-a-ts="9">', '<a data-n-a-sg="S">']
    assert values(spark, pages, lambda c: links.extract_signature(c)["stamp"]) == ["9", None]


def test_fold(spark):
    raw = ["  Minería \t Vicuña ", "straße", "ﬁlo", None, "…½", "Здравй"]
    expected = ["MINERIA VICUNA", "STRASSE", "FILO", "", "...1⁄2", "ЗДРАВИ"]
    assert values(spark, raw, text.fold) == expected
    assert values(spark, raw, text.fold_exact) == expected
    assert [text.fold_text(v) for v in raw] == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=20))
def test_fold_agrees_with_the_driver_form(spark, raw):
    assert values(spark, raw, text.fold) == [text.fold_text(v) for v in raw]


def test_flags(spark):
    assert values(spark, ["Sí", " SI ", "sí", "no", "", None], filters.is_yes) == [True, True, True, False, False, False]


def test_parse_list(spark):
    assert values(spark, ["a, b,,c ", ""], text.parse_list) == [["a", "b", "c"], []]
    assert values(spark, ["a, b,,c "], lambda c: text.parse_list(c, keep_empty=True)) == [["a", "b", "", "c"]]
    assert values(spark, ["a|b"], lambda c: text.parse_list(c, "|")) == [["a", "b"]]


def test_text_assembly(spark):
    pairs = spark.createDataFrame([("t", None), (" ", "s"), (None, None)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    rows = pairs.select(text.combine_text(a, b), text.combine_non_empty(a, b), text.first_non_empty(a, b)).collect()
    assert [tuple(r) for r in rows] == [("t ", "t", "t"), ("  s", "s", " "), (" ", "", None)]


def test_contains_any(spark):
    raw = ["TEXTO ORIGINAL", "OTRO", "", None]
    assert values(spark, raw, lambda c: text.contains_any(c, ["Rigi", "BHP Group", "BHP"])) == [True, False, False, False]
    assert values(spark, raw, lambda c: text.contains_any_word(c, ["Rigi"])) == [False, False, False, False]
    assert values(spark, ["LEY RIGI.", "RIGI_X"], lambda c: text.contains_any_word(c, ["rigi"])) == [True, False]
    assert values(spark, raw, lambda c: text.contains_any(c, [])) == [False] * 4
    assert text.shortest_terms(["BHP Group", "bhp", "Ñu"]) == ["NU", "BHP"]


def test_brand(spark):
    raw = ["TikTok", "tik - tok", "TIKTOKER", "red social", "redes sociales", "tik tok", None]
    expected = [True, True, True, False, True, True, False]
    assert values(spark, raw, lambda c: filters.matches(d.OWN_PATTERN, c)) == expected


def test_tier_and_sentiment(spark):
    assert values(spark, ["Tier 2", "Tier 2b 3", "n/a", "", None], labels.tier_order) == [2, 2, 99, 99, 99]
    raw = ["Positivo (proactivo)", "proactivo", " negativo ", None, "positivo"]
    assert values(spark, raw, labels.sentiment_bucket) == [d.PROACTIVE, d.NEUTRAL, d.NEGATIVE, d.NEUTRAL, d.POSITIVE]
    assert values(spark, list(d.SENTIMENT_ORDER), labels.sentiment_rank) == [0, 1, 2, 3]
    assert values(spark, [" negativo", "POSITIVO!", None], labels.validate_sentiment) == ["NEGATIVO", "NEUTRO", "NEUTRO"]
    assert values(spark, ["positivo", "NEGATIVO", ""], labels.sentiment_color) == ["#2e7d32", "#c62828", "#616161"]


def test_labels(spark):
    raw = ["Product.", "Corporate brand", "Trust and Safety", "xyz", "", None]
    expected = ["Product", "Consumer & Brand", "TnS", "Corporate Reputation", "Corporate Reputation", "Corporate Reputation"]
    assert values(spark, raw, labels.category_from_label_fuzzy) == expected
    raw = ["zoom san juan", "es Zoom San Juan", "BHP Vicuña", "BHP Vicuña Lundin", "", None]
    expected = ["Zoom San Juan", "Minería en general", "BHP Corporativo", "BHP Vicuña Lundin", "Minería en general", "Minería en general"]
    assert values(spark, raw, labels.category_from_label_strict) == expected


def test_rules(spark):
    raw = ["BHP y Vicuña", "texto original", "ley de glaciares", "", None]
    expected = ["BHP Vicuña Lundin", "Contexto argentino", None, None, None]
    assert values(spark, raw, lambda c: labels.category_by_rules(text.fold(c))) == expected


def test_refusals(spark):
    raw = ["", "(x", "Proporciona algo", "por favor, x", "Proporciona la noticia", "Music"]
    assert values(spark, raw, labels.is_refusal_own) == [True, True, True, False, True, False]
    assert values(spark, raw, labels.is_refusal_clipping) == [False, True, False, True, True, False]


def test_prompt(spark):
    made = values(spark, ["  " + "x" * 12010, None], lambda c: labels.build_prompt(c, "<{text}>"))
    assert made == ["<" + "x" * 12010 + ">", "<>"]
    cut = values(spark, ["  " + "x" * 12010], lambda c: labels.build_prompt(c, "<{text}>", 12000))
    assert cut == ["<" + "x" * 12000 + ">"]
    parts = values(spark, ["abcdefg", "", None], lambda c: labels.prompt_parts(c, "<{text}>", 3))
    assert parts == [["<abc>", "<def>", "<g>"], ["<>"], ["<>"]]


def test_dates(spark):
    raw = ["2026-01-05T02:00:00.000Z", "Mon, 05 Jan 2026 10:00:00 GMT", "2026-01-05 01:00:00", "2026-01-05T23:30:00+05:00", "x", None]
    expected = ["04/01/2026", "05/01/2026", "04/01/2026", "05/01/2026", "", ""]
    assert values(spark, raw, dates.local_date_text) == expected
    assert values(spark, ["2026-01-05T10:20:30.5-03:00", "x", None], dates.format_scraped_at) == ["05/01/2026 10:20", "", ""]
    stamps = values(spark, ["5/1/2026 9:05", "05/01/2026 09:05", "x"], dates.parse_scraped_at)
    assert stamps == [datetime(2026, 1, 5, 9, 5)] * 2 + [None]
    assert values(spark, ["01/01/2026", "01/12/2026", ""], dates.week_label) == ["29–04 DEC 2025", "30–06 NOV 2026", ""]


def test_windows(spark):
    monday, tuesday = dates.window_bounds(datetime(2024, 1, 8, 10)), dates.window_bounds(datetime(2024, 1, 9, 10))
    assert (monday.start, monday.end) == (datetime(2024, 1, 5, 9), datetime(2024, 1, 8, 9))
    assert tuesday.start == datetime(2024, 1, 8, 9)
    assert monday.label == "05/01/2024 09:00 - 08/01/2024 09:00"
    stamps = [datetime(2024, 1, 8, 8, 59), datetime(2024, 1, 8, 9), datetime(2024, 1, 5, 9), datetime(2024, 1, 6, 12)]
    days = values(spark, stamps, dates.digest_day, "v timestamp")
    assert days == [date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 8), date(2024, 1, 8)]
    assert values(spark, [date(2024, 1, 8)], dates.digest_label, "v date") == [monday.label]
    hours = [datetime(2024, 1, 8, h) for h in (7, 8, 12, 13, 17, 18, 23)]
    assert values(spark, hours, dates.digest_slot, "v timestamp") == ["18-08", "08-13", "08-13", "13-18", "13-18", "18-08", "18-08"]
    assert [v.day for v in values(spark, hours, dates.slot_date, "v timestamp")] == [8, 8, 8, 8, 8, 9, 9]


def test_cells(spark):
    texts = [None, "None", "NaT", "nan", "x"]
    assert values(spark, texts, lambda c: cells.sanitize(c, StringType())) == ["", "", "", "", "x"]
    assert values(spark, texts, lambda c: cells.sanitize(c, StringType(), False)) == ["", "None", "NaT", "nan", "x"]
    numbers = [None, math.nan, math.inf, -math.inf, 1.0]
    assert values(spark, numbers, lambda c: cells.sanitize(c, DoubleType()), "v double") == ["", "", "", "", "1.0"]
    assert values(spark, [1], lambda c: cells.sanitize(c, LongType()), "v bigint") == ["1"]
    assert values(spark, [True], lambda c: cells.sanitize(c, BooleanType()), "v boolean") == ["true"]
    assert values(spark, ["2.5", "x", None], lambda c: cells.to_number(c, 99)) == [2.5, 99, 99]


def test_countries(spark):
    assert values(spark, ["ar", "cl", "pe", "uy", None], columns.map_country) == ["Argentina", "Chile", "Peru", "uy", None]
    assert values(spark, ["Perú", " Chile ", "x", None], columns.country_flag) == ["🇵🇪", "🇨🇱", "", ""]


def test_paragraphs(spark):
    pages = [
        '<script>var t="</p><p>no";</script><p class="a">One &amp; <b>two</b></p><!-- <p>no</p> --><p>&#233;&#x41;&eacute; &nope;',
        "<p>a<p>b</p><div><P>c</div>d</p><pre>e</pre>",
        "no paragraph",
        None,
    ]
    assert values(spark, pages, html.paragraph_text) == ["One & two éAé &nope;", "a b c", "", ""]
    assert values(spark, ["<p> a </p><p> </p><p>b</p>"], html.body_text) == ["a b"]


def test_paragraphs_with_marks_in_attributes(spark):
    pages = [
        '<p title="a > b">one</p><a href=\'x>y\'><p data-x="</p><p>">two <b title="</div>">bold</b></p></a>',
        "<p>kept</p><!-- open <p>no</p>",
        "<p>kept</p><script>var s = '<p>no</p>';",
        "<p class=it's>odd</p><p>next</p>",
        "<div><p>in <div><p>inner</p> tail</div></div>",
    ]
    assert values(spark, pages, html.paragraph_text) == ["one two bold", "kept", "kept", "odd next", "in  inner"]


def test_dates_by_shape(spark):
    raw = ["10:30", "T10:30", "10:30:00", "5 January 2026", "January 5, 2026", "2026/1/5 13:00", "Jan 5, 2026 1:00", "5 Jan 2026 01:00:00 -0500", "05/01/2026", "ayer", " 2026-01-05 "]
    expected = ["", "", "", "04/01/2026", "04/01/2026", "05/01/2026", "04/01/2026", "05/01/2026", "", "", "04/01/2026"]
    assert values(spark, raw, dates.local_date_text) == expected


def test_card_markup(spark):
    assert values(spark, ['<a b="c">&'], digest.escape_html) == ["&lt;a b=&quot;c&quot;&gt;&amp;"]
