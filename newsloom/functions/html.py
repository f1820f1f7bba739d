"""Paragraph text of stored pages, without a DOM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip, text

# Raw text and comments reach to their end mark, or to the end of the page where it is missing.
_INVISIBLE = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
# A tag with its attributes; quoted values may hold angle brackets. One without a closing quote is left as it is.
_ATTRIBUTES = r"""<(/?[A-Za-z][A-Za-z0-9:-]*+)(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""
_OPEN = r"(?i)<p(?:\s[^>]*)?>"
# A paragraph ends at its own closing tag or where a block element starts or ends.
_BLOCKS = "p|div|article|section|main|aside|header|footer|nav|h[1-6]|ul|ol|li|table|tr|td|th|form|blockquote|pre|body|html"
_CLOSE = rf"(?is)</?(?:{_BLOCKS})\b.*"
_TAG = r"<[^>]*>"


def decode_entities(col: Column) -> Column:
    """Named (HTML 4) and numeric character references as characters; unknown ones stay."""
    pairs = "\n".join(f"{name}\t{chr(cp)}" for name, cp in name2codepoint.items())
    names = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z0-9]+);", 1)
        rest = F.substring(piece, F.length(name) + 2, F.length(piece))
        hexadecimal = F.regexp_extract(name, r"^#[xX](.*)", 1)
        decimal = F.regexp_extract(name, r"^#([0-9]+)", 1)
        cp = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).cast("int")
        valid = cp.between(1, 0xD7FF) | cp.between(0xE000, 0x10FFFF)
        numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32"))
        char = F.coalesce(F.try_element_at(names, name), numeric)
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(col, "&")
    decoded = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), decode), ""))
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)


def _inner(html: Column) -> Column:
    """What stands in each `<p>` element, tags included, in page order.

    Tags lose their attributes first, so that nothing in a quoted value is taken for a tag.
    """
    bare = F.regexp_replace(F.regexp_replace(text(html), _INVISIBLE, ""), _ATTRIBUTES, "<$1>")
    parts = F.split(bare, _OPEN)
    return F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.regexp_replace(p, _CLOSE, ""))


def paragraphs(html: Column, separator: str | None = None) -> Column:
    """The texts of all `<p>` elements in page order, with tags removed and entities decoded.

    Without a `separator` the text around a tag is joined as it stands. With one, the pieces between
    tags are trimmed, blank ones go, and the rest is joined by it.
    """
    if separator is None:
        return F.transform(_inner(html), lambda p: decode_entities(F.regexp_replace(p, _TAG, "")))

    def joined(inner: Column) -> Column:
        nodes = F.transform(F.split(inner, _TAG), lambda node: strip(decode_entities(node)))
        return F.array_join(F.filter(nodes, lambda node: node != ""), separator)

    return F.transform(_inner(html), joined)


def paragraph_text(html: Column) -> Column:
    """All paragraph texts joined by blanks."""
    return F.array_join(paragraphs(html), " ")


def body_text(html: Column) -> Column:
    """Paragraph text for the article body: pieces between tags separated by blanks, empty paragraphs left out."""
    return F.array_join(F.filter(paragraphs(html, " "), lambda p: p != ""), " ")
