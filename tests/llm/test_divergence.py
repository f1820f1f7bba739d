"""Source divergence against a direct computation."""

import re
from collections import Counter

import numpy as np

from newsloom.llm import source_divergence as sd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, top=10):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    texts = [(lang, source, TERM.findall(text.translate(lower))) for lang, source, text in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        docs = Counter(t for x, _, terms in texts if x == lang for t in set(terms))
        kept = sorted(t for t, n in docs.items() if n >= least)
        counts = {s: Counter() for x, s, _ in texts if x == lang}
        for x, s, terms in texts:
            if x == lang:
                counts[s].update(t for t in terms if t in docs and docs[t] >= least)
        whole = sum(counts.values(), Counter())

        def shares(c):
            d = sum(c.values()) + 2 * len(kept)
            return [1 + 10**9 * (c[t] + 2) // d for t in kept]

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for s in counts:
            pairs = sorted((-sum((a - b) ** 2 // (a + b) for a, b in zip(p[s], p[o])), o.encode()) for o in counts if o != s)
            out |= {(lang, s, "pair", o.decode(), -v, n) for n, (v, o) in enumerate(pairs, 1)}
            terms = sorted((-((a - b) ** 2 // (a + b)), t.encode()) for t, a, b in zip(kept, p[s], q) if counts[s][t] and a > b)[:top]
            out |= {(lang, s, "term", t.decode(), -v, n) for n, (v, t) in enumerate(terms, 1)}
    return out


def found(frame, **kw):
    return [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in sd.audit(frame, **kw).collect()]


def corpus(seed, n=160, sources=5):
    chosen = np.random.default_rng(seed)
    words = ["alpha", "Beta", "gämma", "ÉTÉ", "δ", "x", "tail1", "日本", "mid", "zz"]
    rows = [(str(chosen.choice(["en", "de"])), f"s{chosen.integers(sources)}", " ".join(chosen.choice(words, chosen.integers(0, 9)))) for _ in range(n)]
    return rows + [(None, None, None), (None, "s1", "alpha"), ("fr", "only", "alpha beta"), ("de", None, ""), ("en", "S0", "alpha " * 50)]


def test_by_brute_force(spark):
    rows = corpus(1)
    got = found(spark.createDataFrame(rows, "lang string, source string, text string"))
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_tiles_blocks_and_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(2, sources=9)
    want = brute(rows, least=3, top=4)
    for name, value in (("BLOCK_TERMS", 3), ("TILE_GROUPS", 2), ("HELD_COUNTS", 5), ("BLOCK_BYTES", 8), ("PRICED_PAIRS", 2)):
        monkeypatch.setattr(sd, name, value)
    got = found(spark.createDataFrame(rows, "lang string, source string, text string").repartition(3), least_docs=3, top=4)
    assert len(got) == len(set(got)) and set(got) == want


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.array([[1, 0, 1, 0, 1, 0, 1], [1, 0, 1, 0, 2, 0, 1], [1, 0, 1, 0, 1, 0, 1]])
    forest = sd.Forest(counts)
    assert forest.roots[0] == forest.roots[2] != forest.roots[1]
    assert len(forest.levels[0][0]) == 3  # (1, 0), (2, 0) and (1, beyond)
    pair, a, b, places = forest.leaf_pairs(np.array([0]), np.array([1]))
    inside = {(int(forest.values[x]), int(forest.values[y])): int(n) for x, y, n in zip(a, b, places) if x != forest.beyond}
    assert inside == {(1, 1): 3, (0, 0): 3, (1, 2): 1} and set(pair) == {0}


def test_long_division_is_exact():
    for count, whole in ((2, 7), (123_456_789_012_345, 8_999_999_999_999_999), (5, 5), (0, 3)):
        assert sd.exact_share(np.array([count]), whole)[0] == 1 + 10**9 * count // whole


def test_awkward_and_empty(spark, awkward, empty):
    rows = [(r["lang"], r["source"], r["text"]) for r in awkward.collect()]
    got = found(awkward, least_docs=2)
    assert len(got) == len(set(got)) and set(got) == brute(rows, least=2)
    assert found(empty) == []
