"""Boolean trigram queries derived from regular expressions, and the index they are put to.

A query is ALL (no condition), or an "or" of "and" sets of trigrams: a text can match the pattern
only if it holds every trigram of one of the sets. Texts and literals are folded to lower case, so
one index serves patterns in either case.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser

import numpy as np

Query = frozenset[frozenset[str]]

#: The query that every text meets.
ALL: Query = frozenset([frozenset()])

EXACT_LIMIT = 64
CLASS_LIMIT = 8


def _grams(literal: str) -> frozenset[str]:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2))


def _minimal(sets: set[frozenset[str]]) -> Query:
    """Without the sets that hold another one: they add nothing to an "or"."""
    return frozenset(s for s in sets if not any(o < s for o in sets))


def _either(a: Query, b: Query) -> Query:
    return _minimal(set(a | b))


def _both(a: Query, b: Query) -> Query:
    return _minimal({x | y for x in a for y in b})


def _flush(strings: frozenset[str]) -> Query:
    return _minimal({_grams(s) for s in strings})


def _class_members(items: list) -> frozenset[str] | None:
    """The folded characters of a class; None where it is negated or large."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < CLASS_LIMIT:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= CLASS_LIMIT else None


def _walk(nodes: list) -> tuple[frozenset[str] | None, Query]:
    """Of a sequence: all strings it can match where they are few, and the query that holds besides."""
    exact: frozenset[str] = frozenset([""])
    whole, query = True, ALL
    for node in nodes:
        part, needs = _node(node)
        if part is not None and len(part) * len(exact) <= EXACT_LIMIT:
            exact = frozenset(a + b for a in exact for b in part)
            continue
        query = _both(_both(query, _flush(exact)), needs if part is None else _flush(part))
        exact, whole = frozenset([""]), False
    return (exact, query) if whole else (None, _both(query, _flush(exact)))


def _node(node: tuple) -> tuple[frozenset[str] | None, Query]:
    kind, value = node
    if kind is op.LITERAL:
        return frozenset([chr(value).lower()]), ALL
    if kind is op.IN:
        return _class_members(value), ALL
    if kind is op.SUBPATTERN:
        return _walk(list(value[-1]))
    if kind is op.BRANCH:
        branches = [_walk(list(b)) for b in value[1]]
        if all(part is not None for part, _ in branches) and sum(len(p) for p, _ in branches) <= EXACT_LIMIT:
            return frozenset().union(*(p for p, _ in branches)), ALL
        query = None
        for part, needs in branches:
            own = needs if part is None else _both(needs, _flush(part))
            query = own if query is None else _either(query, own)
        return None, query
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        part, needs = _walk(list(inner))
        if (least, most) == (0, 1) and part is not None:
            return part | {""}, ALL
        if least == most == 1:
            return part, needs
        return None, ALL if least == 0 else needs if part is None else _flush(part)
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return frozenset([""]), ALL
    return None, ALL


def trigram_query(pattern: str) -> Query:
    """The trigrams that a match of `pattern` cannot do without; ALL where it has none."""
    exact, query = _walk(list(_parser.parse(pattern)))
    return query if exact is None else _flush(exact)


class BlockIndex:
    """Inverted index of one block of texts: trigram to the sorted rows that hold it.

    Postings are kept for the trigrams that queries name, each made once for the whole block.
    """

    def __init__(self, texts: list[str]) -> None:
        self.folded = [t.lower() for t in texts]
        self.rows = np.arange(len(texts))
        self.postings: dict[str, np.ndarray] = {}

    def posting(self, gram: str) -> np.ndarray:
        if gram not in self.postings:
            self.postings[gram] = np.array([i for i, t in enumerate(self.folded) if gram in t], dtype=np.int64)
        return self.postings[gram]

    def candidates(self, query: Query) -> np.ndarray:
        """Rows that meet the query: postings intersected per set, united over the sets."""
        found = self.rows[:0]
        for grams in query:
            rows = self.rows
            for gram in sorted(grams):
                rows = np.intersect1d(rows, self.posting(gram), assume_unique=True)
                if not len(rows):
                    break
            found = np.union1d(found, rows)
        return found.astype(np.int64)
