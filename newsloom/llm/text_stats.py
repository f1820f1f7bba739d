"""Statistics of whole texts as Spark expressions, shared by the quality operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let, literal_array
from newsloom.llm.common import SPACE, whole_text

#: Common short words of four languages.
STOPWORDS = (
    "the of and to in is that it for with was as by be are this on at from what "
    "de la le les et des un une du en que qui dans pour par sur est au avec il "
    "der die das und in zu den von ist mit sich auf für nicht im ein eine als auch "
    "el los las y del se que no una por con su para es al lo como"
).split()

WORDS, TRIPLES, LINES = "_words", "_triples", "_lines"


def words_of(text: Column) -> Column:
    """Words between white space (blank, tab to carriage return)."""
    return F.array_remove(F.split(text, SPACE), "")


def triples_of(words: Column) -> Column:
    """The three-word windows of a text, in order; words hold no blank, so joining them loses nothing."""
    starts = F.sequence(F.lit(1), F.size(words) - 2)
    window = F.transform(starts, lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))
    return F.when(F.size(words) >= 3, window).otherwise(F.array().cast("array<string>"))


def with_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """Words, three-word windows and lines with a word, as working columns."""
    whole = whole_text(text)
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumns({WORDS: words_of(whole), LINES: lines})
    return split.withColumn(TRIPLES, triples_of(F.col(WORDS)))


def covered_words(triples: Column) -> Column:
    """Words that lie in a window which occurs more than once, its first place included.

    Windows are sorted with their places; equal neighbours are repeats. Each repeated place then adds
    the words that the one before it does not cover.
    """

    def places(ordered: Column) -> Column:
        last = F.size(ordered)
        repeated = F.filter(
            F.sequence(F.lit(1), last),
            lambda k: (
                (k > 1) & (F.element_at(ordered, k)["w"] == F.element_at(ordered, F.greatest(k - 1, F.lit(1)))["w"])
                | (k < last) & (F.element_at(ordered, k)["w"] == F.element_at(ordered, F.least(k + 1, last))["w"])
            ),
        )
        return F.array_sort(F.transform(repeated, lambda k: F.element_at(ordered, k)["i"]))

    def count(ordered: Column) -> Column:
        start = F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n"))
        return F.aggregate(
            places(ordered),
            start,
            lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(3), i - acc["at"])).alias("n")),
            lambda acc: acc["n"],
        )

    ordered = F.sort_array(F.transform(triples, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(triples)) == F.size(triples), F.lit(0)).otherwise(let(ordered, count))


def base_counts() -> dict[str, Column]:
    """The counts that quality rules start from, over the working columns and the text."""
    text = whole_text()
    return {
        "n_words": F.size(WORDS).cast("long"),
        "word_chars": F.length(F.array_join(WORDS, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(LINES) - F.size(F.array_distinct(LINES))).cast("long"),
        "n_repeat_words": covered_words(F.col(TRIPLES)).cast("long"),
    }


def shape_counts() -> dict[str, Column]:
    """Further counts: shouted words, marks in a row, lines, distinct words and windows, stop words, digits, sentence ends."""
    text = whole_text()
    return {
        "n_shouted": F.regexp_count(text, F.lit(r"\p{Lu}{2,}")).cast("long"),
        "n_marks": F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long"),
        "n_lines": F.size(LINES).cast("long"),
        "n_distinct": F.size(F.array_distinct(WORDS)).cast("long"),
        "n_stopwords": F.size(F.array_intersect(F.col(WORDS), literal_array(STOPWORDS))).cast("long"),
        "n_digits": F.regexp_count(text, F.lit(r"[0-9]+")).cast("long"),
        "n_ends": F.regexp_count(text, F.lit(r"[.!?](?=\s|$)")).cast("long"),
        "n_chars": F.length(text).cast("long"),
    }


def share(part: str, whole: str) -> Column:
    """A ratio of two counts, 0 where there is nothing to share."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
