"""Matching a text table against a term table of any size by substring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let, literal_array
from newsloom.session import written

GRAM = 4


def _grams(col: Column, length: int) -> Column:
    """All substrings of one length, found in a single scan of the text."""
    return F.regexp_extract_all(col, F.lit(rf"(?s)(?=(.{{{length}}}))"), F.lit(1))


def _words(folded: Column) -> Column:
    """The distinct stretches of a text between blanks; a text with a blank also has the empty one."""
    return F.array_distinct(F.concat(F.split(folded, " "), F.when(F.contains(folded, F.lit(" ")), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))))


def _anchor(term: Column) -> Column:
    """The longest stretch of a term between blanks, the first of equally long ones: it lies inside a word of every text with the term."""
    parts = F.split(term, " ")
    return F.element_at(F.filter(parts, lambda p: F.length(p) == F.array_max(F.transform(parts, F.length))), 1)


def _words_with(words: DataFrame, anchors: DataFrame) -> DataFrame:
    """Pairs (`_word`, `_anchor`) where the word contains the anchor.

    A word can only contain an anchor that has all its grams, so both sides meet in an equi-join on one gram
    of the anchor, and `contains` settles the rest: no nested loop, and one way for tables of any size.
    The words' grams are first cut down, by a join, to those that some anchor has; the number of words that
    hold each is then counted, and every anchor meets the words on its rarest gram. Anchors shorter than a
    gram are their own gram. What is used twice is written.
    """
    own = F.when(F.length("_anchor") < GRAM, F.array("_anchor")).otherwise(F.array_distinct(_grams(F.col("_anchor"), GRAM)))
    pairs = written(anchors.select("_anchor", F.explode(own).alias("_gram")), "grams")
    lengths = sorted(row[0] for row in pairs.select(F.length("_gram").alias("n")).distinct().collect())  # GRAM + 1 values at most
    empty = F.array().cast("array<string>")
    grams = F.array_distinct(F.concat(empty, *[_grams(F.col("_word"), n) if n else F.when(F.col("_word") == "", F.array(F.lit(""))).otherwise(empty) for n in lengths]))
    # An outer explode: the plain one adds a filter that would compute the grams a second time.
    seen = written(words.select("_word", F.explode_outer(grams).alias("_gram")).join(written(pairs.select("_gram").distinct(), "grams"), "_gram"), "seen")
    counts = seen.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    weighed = pairs.join(counts, "_gram", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    rarest = weighed.groupBy("_anchor").agg(F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram"))
    return seen.join(rarest, "_gram").where(F.contains(F.col("_word"), F.col("_anchor"))).select("_word", "_anchor")


def term_match(texts: DataFrame, terms: DataFrame, key: Sequence[str], folded: str = "folded", term: str = "term") -> DataFrame:
    """Pairs (text key, term columns) where the folded text contains the term as a substring.

    Every term lies in a text by its longest stretch without a blank, and that lies inside one of the
    text's words. So the texts are read once, for their distinct words; the terms are matched with the
    vocabulary, which grows far slower than the texts, and only words with a term are joined back.
    A term without blanks is settled by that; for others the candidate texts are fetched and searched.
    Terms shorter than a gram, of which there are no more than the letters can form, lie in most words and
    are searched in the texts themselves in the same pass.
    Each text's words are written once, as one row, so that no text is folded twice and no word is shuffled
    with its text's key unless the words with a term are too many to be sent to all tasks. What joins are
    chosen by is written, so that Spark knows its size.
    """
    present = terms.where(F.col(term) != "")
    names = written(present.select(term).distinct().withColumn("_anchor", _anchor(F.col(term))), "terms")
    short = ~F.contains(F.col(term), F.lit(" ")) & (F.length(term) < GRAM)
    few = literal_array(sorted(row[0] for row in names.where(short).select(term).collect()))
    parts = let(F.col(folded), lambda t: F.struct(_words(t).alias("words"), F.filter(few, lambda w: F.contains(t, w)).alias("few")))
    held = written(texts.select(*key, parts.alias("_p")), "texts")
    words = held.select(*key, F.explode("_p.words").alias("_word"))
    matched = _words_with(words.select("_word").distinct(), names.where(~short).select("_anchor").distinct())
    of_word = written(matched.join(names.where(~short), "_anchor").groupBy("_word").agg(F.collect_list(term).alias("_terms")), "words")
    found = words.join(of_word, "_word").select(*key, F.explode("_terms").alias(term)).distinct()
    found = found.unionByName(held.select(*key, F.explode("_p.few").alias(term)))
    blank = F.contains(F.col(term), F.lit(" "))
    if not names.where(blank).isEmpty():
        # Never NULL, so that no not-null filter on the folded text, and with it the fold, goes to the scan.
        contained = F.coalesce(F.contains(F.col(folded), F.col(term)), F.lit(False))
        # Spark takes computed texts for short ones; the hint keeps it from broadcasting them on that ground.
        searched = found.where(blank).join(texts.select(*key, folded).hint("merge"), list(key)).where(contained).drop(folded)
        found = found.where(~blank).unionByName(searched)
    return found.join(present, term).select(*key, *terms.columns)


def texts_with_terms(texts: DataFrame, terms: DataFrame, key: Sequence[str], **columns: str) -> DataFrame:
    """Texts that contain at least one term (semi join)."""
    return texts.join(term_match(texts, terms, key, **columns).select(*key).distinct(), list(key), "left_semi")


def texts_without_terms(texts: DataFrame, terms: DataFrame, key: Sequence[str], **columns: str) -> DataFrame:
    """Texts that contain none of the terms (anti join)."""
    return texts.join(term_match(texts, terms, key, **columns).select(*key).distinct(), list(key), "left_anti")
