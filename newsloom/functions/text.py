"""Trimming, accent folding, term patterns and text assembly."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def text(col: Column) -> Column:
    """NULL as the empty string, anything else as text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    """Trim every kind of Unicode white space, not only ASCII blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_array(values: Iterable[str]) -> Column:
    """A constant array of texts, built in one expression however long it is."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>")


def clean_value(col: Column) -> Column:
    return strip(text(col))


def first_non_empty(*cols: Column) -> Column:
    """The first column that is neither NULL nor empty; NULL when there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def combine_text(*cols: Column) -> Column:
    """Space-joined text; NULL and empty parts keep their place."""
    return F.concat_ws(" ", *[text(c) for c in cols])


def combine_non_empty(*cols: Column, separator: str = " | ") -> Column:
    """Trimmed parts joined by `separator`, skipping the empty ones."""
    return F.concat_ws(separator, *[F.nullif(clean_value(c), F.lit("")) for c in cols])


def parse_list(col: Column, separator: str = ",", keep_empty: bool = False) -> Column:
    """Split on `separator` (taken literally) and trim; empty parts go unless `keep_empty`."""
    parts = F.transform(F.split(col, re.escape(separator)), strip)
    return parts if keep_empty else F.filter(parts, lambda part: part != "")


def fold_text(value: str | None) -> str:
    """Driver-side form of `fold`, used for term lists."""
    decomposed = unicodedata.normalize("NFKD", value or "")
    bare = "".join(ch for ch in decomposed if not unicodedata.combining(ch))
    return " ".join(bare.split()).upper()


# Stand-ins, from the last private-use plane, for characters whose folded form has several characters.
_STAND_INS = (0x10FF00, 0x10FFFD)


@lru_cache(maxsize=1)
def _fold_maps() -> tuple[str, str, dict[str, str]]:
    """`translate` arguments and the replacements of the stand-ins, derived from the Unicode data.

    Characters with a one-character compatibility form are mapped to it and bare combining marks
    are deleted. Longer forms are taken for Latin letters, punctuation, letter-like signs,
    fractions and ligatures; other scripts with longer forms need `fold_exact`.
    """
    singles: dict[str, str] = {}
    deleted: list[str] = []
    longer: dict[str, str] = {}
    for cp in range(0x10000):
        ch = chr(cp)
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF or ch == " ":
            continue
        if ch.isspace():
            singles[ch] = " "
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if folded == ch:
            continue
        if not folded:
            deleted.append(ch)
        elif len(folded) == 1:
            singles[ch] = folded
        elif cp < 0x250 or 0x2000 <= cp < 0x2190 or 0xFB00 <= cp <= 0xFB06:
            stand_in = chr(_STAND_INS[0] + len(longer))
            singles[ch] = stand_in
            longer[stand_in] = folded
    return "".join(singles) + "".join(deleted), "".join(singles.values()), longer


def strip_marks(col: Column) -> Column:
    """Compatibility decomposition without combining marks, every white space a blank.

    One `translate` pass does the work; texts with a character of several folded characters get
    these put in afterwards.
    """
    matching, replacement, longer = _fold_maps()
    plain = F.translate(col, matching, replacement)
    chars, forms = literal_array(longer), literal_array(longer.values())
    marked = f"[{chr(_STAND_INS[0])}-{chr(_STAND_INS[1])}]"

    def put_in(t: Column) -> Column:
        positions = F.sequence(F.lit(1), F.lit(len(longer)))
        longest = F.aggregate(
            positions, t, lambda done, i: F.replace(done, F.element_at(chars, i), F.element_at(forms, i))
        )
        return F.when(t.rlike(marked), longest).otherwise(t)

    return let(plain, put_in)


def fold(col: Column) -> Column:
    """Accent-free upper-case text with single blanks, for matching."""
    return F.trim(F.upper(F.regexp_replace(strip_marks(text(col)), " {2,}", " ")))


def fold_flag(col: Column) -> Column:
    """Accent-free lower-case text, for short editorial flags."""
    return strip_marks(F.lower(clean_value(col)))


@F.pandas_udf(StringType())
def fold_exact(values: pd.Series) -> pd.Series:
    """`fold` for every script, in Arrow batches; only needed where `fold` does not reach."""
    return values.map(fold_text)


def shortest_terms(terms: Iterable[str]) -> list[str]:
    """The folded terms without those that contain another one: they add nothing to a search for any."""
    needed: list[str] = []
    for term in sorted({fold_text(t) for t in terms} - {""}, key=lambda t: (len(t), t)):
        if not any(short in term for short in needed):
            needed.append(term)
    return needed


def contains_any(folded: Column, terms: Iterable[str]) -> Column:
    """True when the folded text contains one of the terms; no term or no text is false.

    Plain substring searches over a literal array, measured faster than one large alternation.
    """
    needed = shortest_terms(terms)
    if not needed:
        return F.lit(False)
    literals = literal_array(needed)
    return let(text(folded), lambda t: F.exists(literals, lambda term: F.contains(t, term)))


def contains_any_word(folded: Column, terms: Iterable[str]) -> Column:
    """As `contains_any`, for terms that stand as whole words."""
    pattern = alternation_words(terms)
    return text(folded).rlike(pattern) if pattern else F.lit(False)


def alternation_words(terms: Iterable[str]) -> str:
    folded = sorted({fold_text(t) for t in terms} - {""})
    return rf"(?U)(?<!\w)(?:{'|'.join(re.escape(t) for t in folded)})(?!\w)" if folded else ""
