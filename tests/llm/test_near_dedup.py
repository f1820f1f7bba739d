import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from newsloom.llm import near_dedup
from newsloom.llm.components import components, union_find


def sets_of(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) or frozenset([tuple(words)])


def brute(docs, width=4, percent=80):
    """Smallest id reachable over all pairs."""
    docs = [(d, sets_of(t, width)) for d, t in docs if d is not None]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(docs):
        for b, t in docs[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(s), root(d)) for d, s in docs}


def check(rows, docs, width=4):
    want = brute(docs, width)
    assert len(rows) == len(docs)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def family(random, size, words, first, changes):
    """Texts that each change a few words of one text, so that most but not all pairs are linked."""
    base = [f"f{first}w{random.randrange(10**6)}" for _ in range(words)]
    made = []
    for i in range(size):
        own = list(base)
        for _ in range(random.randint(0, changes)):
            own[random.randrange(words)] = f"x{random.randrange(10**6)}"
        made.append((first + i, " ".join(own)))
    return made


@pytest.mark.parametrize("cell", [1000, 7])
def test_families_by_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    random.seed(5)
    docs = family(random, 60, 120, 1000, 6) + family(random, 40, 60, 2000, 4) + family(random, 30, 300, 3000, 25)
    shared = " ".join(f"common{i}" for i in range(60))
    docs += [(4000 + i, shared + " " + " ".join(f"own{i}_{k}" for k in range(10 + i % 12))) for i in range(60)]
    docs += [(5000 + i, docs[i % 50][1]) for i in range(80)]
    random.shuffle(docs)
    check(near_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_awkward(spark, awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check(near_dedup.groups(awkward).collect(), docs)
    check(near_dedup.groups(awkward, width=5).collect(), docs, 5)
    assert near_dedup.groups(empty).collect() == []
    left = near_dedup.deduplicate(awkward)
    assert left.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    want = {d for d, (_, c) in brute(docs).items() if d == c}
    assert ids == sorted([*map(str, want), "None", "None"])


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for width in (4, 5):
        check(near_dedup.groups(docs, width).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], width)


def test_signatures_estimate_similarity():
    random = np.random.default_rng(3)
    with np.errstate(over="ignore"):
        for size in (3, 20, 500):
            errors = []
            for _ in range(60):
                both = np.unique(random.integers(0, 2**63, 2 * size).astype(np.uint64))
                a, b = both[: int(1.5 * size)], both[int(0.5 * size) :]
                true = len(np.intersect1d(a, b)) / len(both)
                errors.append((near_dedup.super_minhash([a])[0] == near_dedup.super_minhash([b])[0]).mean() - true)
            assert abs(np.mean(errors)) < 0.02, (size, np.mean(errors))
            # No more spread than independent hash functions would have.
            assert np.std(errors) < 1.15 * (0.25 / near_dedup.SLOTS) ** 0.5, (size, np.std(errors))


def test_equal_sets_have_equal_signatures():
    with np.errstate(over="ignore"):
        a = near_dedup.shingle_set("A b c d e f g", 4)
        b = near_dedup.shingle_set("a B\tc\n d e\x0bf g", 4)
        assert (a == b).all() and (near_dedup.super_minhash([a, a[:3]])[0] == near_dedup.super_minhash([b])[0]).all()
        assert len(near_dedup.shingle_set(" \n", 4)) == 0 and len(near_dedup.shingle_set("x y", 4)) == 1
        assert near_dedup.shingle_set("x y", 4)[0] != near_dedup.shingle_set("y x", 4)[0]


def reach(edges):
    parent = defaultdict(lambda: None)

    def root(x):
        while parent[x] is not None:
            x = parent[x]
        return x

    nodes = {n for e in edges for n in e}
    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes if root(n) != n}


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(5)
    assert {r["node"]: r["component"] for r in components(frame).collect()} == reach(edges)
    assert components(frame.where("false")).collect() == []
    block = union_find(pd.DataFrame(edges, columns=["u", "v"]))
    assert dict(zip(block["u"], block["v"])) == reach(edges)


def test_dealt_rows_grow_in_proportion_with_a_bucket(spark, monkeypatch):
    """Near copies of one component and few outsiders: no row is copied for each block of its own component."""
    monkeypatch.setattr(near_dedup, "CELL", 100)
    counts = []
    for n in (1000, 2000):
        rows = [(1, k, 1, 50, 0 if k % (n // 4) else k) for k in range(n)]
        members = spark.createDataFrame(rows, "band long, rep long, which int, n_shingles long, component long")
        counts.append(near_dedup._dealt(members).count())
    assert counts[1] <= 2.1 * counts[0] and counts[0] < 1.2 * 1000


def test_rows_of_one_id_with_different_texts(spark):
    a, b = (" ".join(f"{p}{i}" for i in range(60)) for p in "ab")
    docs = [(1, a + " x"), (7, a), (7, b), (9, b + " y"), (3, "else " + " ".join(f"c{i}" for i in range(30)))]
    rows = near_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(1, 1), (3, 3), (7, 1), (7, 1), (9, 1)]


def test_hot_pivots_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PIVOT_PAIRS", 5)
    random.seed(8)
    docs = family(random, 50, 80, 100, 3)
    check(near_dedup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)
