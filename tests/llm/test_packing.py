import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm import packing, token_shards
from newsloom.llm.tokens import default_vocabulary, document_ids, encoder
from newsloom.session import shared_dir

ODD = ["a  b\t c\n\n'sÉ it's don't  x’s I'LL 'Reé'd_x__9²¼×ƁǅǄ", "ǅ İstanbul ΣΑΣ Σ. é ́a a ́b", "<|endoftext|> x<|startoftext|>", "", "  \n ", "日本語 テスト①½ \x1c a\x85b c", "ſK ß ẞ aſb"]


def test_ids_are_those_of_the_whole_text(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_vocabulary())
    found = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    ranges = ["".join(chr(c) for c in range(a, a + 40)) for a in range(33, 0x24F, 40)]
    for text in found + ODD + ranges:
        ids = np.frombuffer(encoder(default_vocabulary()).encode(text), dtype="<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text[:80]


def brute_sequences(lengths, capacity):
    """Fewest sequences by trying every way to fill each in turn."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = None
    for k in range(len(rest) + 1):
        for chosen in combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in chosen) <= capacity:
                left = brute_sequences(tuple(rest[i] for i in range(len(rest)) if i not in chosen), capacity)
                best = left + 1 if best is None else min(best, left + 1)
    return best


@given(st.lists(st.integers(1, 20), max_size=7))
@settings(max_examples=60, deadline=None)
def test_small_plans_are_optimal(lengths):
    plan = packing.complete(dict(Counter(lengths)), 20)
    assert sum(times for _, times in plan) == brute_sequences(tuple(sorted(lengths, reverse=True)), 20)


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece(seed):
    random.seed(seed)
    histogram = dict(Counter(random.randint(1 + 5 * seed, 60) for _ in range(400)))
    plan = packing.complete(histogram, 100)
    held = Counter()
    for content, times in plan:
        assert sum(content) <= 100
        for length in content:
            held[length] += times
    assert held == Counter(histogram)
    assert sum(t for _, t in plan) <= sum(t for _, t in packing.best_fit(histogram, 100))


def check_packed(rows, docs, capacity):
    ids = {}
    for doc_id, text in docs:
        ids.setdefault(doc_id, []).append(np.frombuffer(document_ids(text or "", default_vocabulary()), dtype="<u4"))
    wanted = Counter()
    for doc_id, several in ids.items():
        for own in several:
            for piece, start in enumerate(range(0, len(own), capacity)):
                part = own[start : start + capacity]
                wanted[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_awkward_documents_are_packed(spark, awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check_packed(packing.pack(awkward).collect(), docs, 4096)
    check_packed(packing.pack(awkward, capacity=7).collect(), docs, 7)
    assert packing.pack(empty).collect() == []


def test_whole_table_needs_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs).collect()
    used = check_packed(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 4096)
    assert used <= -(-sum(r["length"] for r in rows) // 4096) + 1


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_bijection(size):
    slots = token_shards.permute(np.arange(size), size, key=9)
    assert sorted(slots) == list(range(size))
    assert (token_shards.permute(slots, size, key=9, inverse=True) == np.arange(size)).all()


@pytest.mark.parametrize("source", ["awkward", "sf"])
def test_shards_give_every_document_back(spark, awkward, source):
    docs = awkward if source == "awkward" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    root = shared_dir(spark, "shards")
    rows = token_shards.write_shards(docs, root, key=3, length=64, slots=32).collect()
    sequences = list(token_shards.read_sequences(root))
    total = sum(r["length"] for r in rows)
    assert len(sequences) == -(-total // 64)
    assert [s.tolist() for s in token_shards.read_sequences(root, 40)] == [s.tolist() for s in sequences[40:]]
    back = Counter()
    parts = {}
    for r in rows:
        at = r["byte_offset"] // 2 - r["slot"] % 32 * 64
        parts.setdefault(r["doc_id"], []).append((r["start"], sequences[r["slot"]][at : at + r["length"]].tolist()))
    for doc_id, own in parts.items():
        back[doc_id] = sum(len(ids) for _, ids in own)
    wanted = Counter()
    by_id = {}
    for r in docs.collect():
        ids = np.frombuffer(document_ids(r["text"] or "", default_vocabulary()), dtype="<u4").tolist()
        wanted[r["doc_id"]] += len(ids)
        by_id.setdefault(r["doc_id"], []).append(ids)
    assert back == wanted
    for doc_id, several in by_id.items():
        if len(several) == 1:
            assert [i for _, ids in sorted(parts[doc_id]) for i in ids] == several[0]


def test_no_documents_no_shards(spark, empty):
    assert token_shards.write_shards(empty, shared_dir(spark, "shards"), key=3).collect() == []


def test_search_reports_bound_and_proof():
    """The bound holds on random small plans, a proven plan is the best, and many tiny pieces need no deep recursion."""
    random = np.random.default_rng(7)
    for _ in range(60):
        lengths = [int(x) for x in random.integers(1, 21, random.integers(1, 10))]
        found, least = packing.search(dict(Counter(lengths)), 20), brute_sequences(lengths, 20)
        assert found.bound <= least <= found.size and (not found.proven or found.size == least)
        assert sum(times for _, times in found.plan) == found.size
    three = packing.search(dict(Counter(int(x) for x in random.integers(1000, 1800, 90))), 4096)
    assert three.steps <= packing.EFFORT + 10_000 and three.bound <= three.size
    pairs = packing.search(dict(Counter(int(x) for x in random.integers(1400, 2040, 301))), 4096)
    assert pairs.proven and pairs.size == 151
    tiny = packing.search({4095: 3, 1: 9000, 2: 5, 2047: 2}, 4096)
    assert tiny.proven
