import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from newsloom.llm import lm_scoring


def test_by_brute_force(spark, awkward):
    rows = [(1, "a b a b c", True), (2, "a b b x", False), (3, "A  c\n a b", True), (4, None, True), (5, "", False), (6, "x y z a b", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    for size, bigrams in ((3, 100), (100, 100), (100, 2)):
        model = lm_scoring.train(docs.where("not good"), docs.where("good"), size=size, bigrams=bigrams)
        counts = Counter(w for _, t, _ in rows for w in (t or "").lower().split())
        many = Counter(counts.values())
        least = min((n for n in many if sum(k for m, k in many.items() if m >= n) <= size), default=99)
        top = sorted((w for w in counts if counts[w] >= least), key=lambda w: (-counts[w], w))
        assert model.known == {w: i for i, w in enumerate(top, 2)}
        grams = {"background": Counter(), "target": Counter()}
        for _, text, good in rows:
            ids = [0] + [model.known.get(w, 1) for w in (text or "").lower().split()]
            for pair in zip(ids, ids[1:]):
                grams["target" if good else "background"][pair] += 1
        both = grams["background"] + grams["target"]
        of_count = Counter(both.values())
        kept, taken = set(), 0
        for n in sorted(of_count, reverse=True):
            if taken + of_count[n] > bigrams:
                break
            taken += of_count[n]
            kept |= {p for p, k in both.items() if k == n}
        assert {divmod(int(k), model.size) for k in model.keys} == kept
        for which, own in grams.items():
            total = {w: sum(n for (_, b), n in own.items() if b == w) + 1 for w in range(1, model.size)}
            before = Counter()
            for (a, _), n in own.items():
                before[a] += n

            def p(a, b):
                seen = {k: max(own[k] - 0.75, 0) / max(before[a], 1) for k in kept if k[0] == a}
                return seen.get((a, b), 0) + max(1 - sum(seen.values()), 1e-6) * total[b] / sum(total.values())

            for r in lm_scoring.score(docs, model).collect():
                ids = [0] + [model.known.get(w, 1) for w in (r["text"] or "").lower().split()]
                want = -sum(math.log(p(a, b)) for a, b in zip(ids, ids[1:])) / max(1, len(ids) - 1)
                assert abs(r[f"{which}_loss"] - want) < 1e-9
                assert r["n_tokens"] == len(ids) - 1


def test_models_are_distributions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lm_scoring.train(docs, docs.where("doc_id % 2 = 0"), size=50)
    for which in ("target", "background"):
        for before in range(model.size):
            mass = model.left[which][before] * model.unigram[which].sum()
            mass += model.bigram[which][model.keys // model.size == before].sum()
            assert abs(mass - 1) < 1e-5


def test_target_like_documents_score_lower(spark):
    rows = [(i, " ".join(np.random.default_rng(i).choice(["ka", "ke", "ki", "ko"] if i % 2 else ["ta", "te", "ti", "to"], 40).tolist())) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm_scoring.train(docs, docs.where("doc_id % 2 = 1 AND doc_id < 30"))
    found = {r["doc_id"]: r["cross_entropy_difference"] for r in lm_scoring.score(docs, model).collect()}
    assert max(v for k, v in found.items() if k % 2) < min(v for k, v in found.items() if not k % 2)


def test_edges(spark, awkward, empty):
    model = lm_scoring.train(awkward, empty)
    rows = lm_scoring.score(awkward, model).collect()
    assert len(rows) == awkward.count()
    assert all(math.isfinite(r["cross_entropy_difference"]) for r in rows)
    assert all(r["cross_entropy_difference"] == 0 for r in rows if not r["n_tokens"])
    nothing = lm_scoring.train(empty, empty)
    assert all(math.isfinite(r["target_loss"]) for r in lm_scoring.score(awkward, nothing).collect())
    assert lm_scoring.score(empty, model).collect() == []


def test_all_counts_are_kept(spark, monkeypatch):
    """By default the losses are those of all words and bigrams, wherever the values are looked up."""
    random = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in random.zipf(1.3, 60) % 500)) for i in range(40)] + [(90, None), (91, "w1 w1 w2"), (91, "w1 w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.where("doc_id % 3 = 0")
    other = spark.createDataFrame([(0, "w1 never w2 seen"), (1, "w3 w1 w1")], "doc_id long, text string")
    grams = {"background": Counter(), "target": Counter()}
    for d, text in rows:
        words = [None, *(text or "").split()]
        for pair in zip(words, words[1:]):
            grams["background"][pair] += 1
            grams["target"][pair] += d % 3 == 0
    known = {b for _, b in grams["background"]}

    def loss(which, text):
        own, words = +grams[which], [None, *(text or "").split()]
        total = 0.0
        for a, b in zip(words, words[1:]):
            before = sum(n for (x, _), n in own.items() if x == a)
            left = 0.75 * sum(x == a for x, _ in own) / before if before else 1
            unigram = (sum(n for (_, y), n in own.items() if y == b) + 1) / (sum(own.values()) + len(known) + 1)
            total -= math.log(max(own[a, b] - 0.75, 0) / max(before, 1) + left * unigram)
        return total / max(1, len(words) - 1)

    for words, bigrams in ((1 << 17, 1 << 19), (5, 7), (0, 0)):
        monkeypatch.setattr(lm_scoring, "SENT_WORDS", words)
        monkeypatch.setattr(lm_scoring, "SENT_BIGRAMS", bigrams)
        model = lm_scoring.train(docs, target)
        for given in (docs, other):
            found = lm_scoring.score(given, model).collect()
            assert len(found) == given.count()
            for r in found:
                assert r["n_tokens"] == len((r["text"] or "").split())
                for which in grams:
                    assert abs(r[f"{which}_loss"] - loss(which, r["text"])) < 1e-9


def test_no_word_or_bigram_is_cut(spark):
    """More distinct words than any fixed vocabulary: each is counted, none is the unknown word."""
    docs = spark.createDataFrame([(i, " ".join(f"v{i}x{j}" for j in range(1000))) for i in range(70)], "doc_id long, text string")
    model = lm_scoring.train(docs, docs.where("doc_id < 3"))
    assert model.size == 70_000 and model.bigrams.count() == 70_000


def test_bigrams_travel_packed_by_blocks(spark, monkeypatch):
    """No table has a row for each bigram, what is written takes a few bytes of each, and several blocks give the same losses."""
    made = []
    monkeypatch.setattr(lm_scoring, "written", lambda rows, purpose, f=lm_scoring.written: made.append(f(rows, purpose)) or made[-1])
    random = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{int(x)}" for x in random.zipf(1.2, 500) % 30_000)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grams = {pair for _, t in rows for pair in zip([None, *t.split()], t.split())}
    found = []
    for chars in (1 << 30, 20_000):
        made.clear()
        monkeypatch.setattr(lm_scoring, "BLOCK_CHARS", chars)
        model = lm_scoring.train(docs, docs.where("doc_id % 5 = 0"))
        found.append({r["doc_id"]: (r["target_loss"], r["background_loss"]) for r in lm_scoring.score(docs, model).collect()})
        assert model.bigrams.count() == len(grams)
        if chars == 1 << 30:
            assert sum(t.count() for t in made) < len(grams) / 10
            size = sum((f.getLen() for t in made for p in t.inputFiles() for f in _files(spark, p)), 0)
            assert size < 16 * len(grams), size / len(grams)
    assert all(np.allclose(found[0][d], found[1][d], rtol=1e-12) for d in found[0])


def _files(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)


def test_words_of_a_block_are_split_as_by_the_pattern(spark):
    """White space is ASCII only, letters are lowered by text, and blocks may be cut after any text."""
    texts = ["A\u00a0b c\x0bd\x0ce\r\n", "ΑΣ", "x ΑΣ y", "İ \x1c a\x85b", "", "ſK 日本語"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in lm_scoring.score(docs, lm_scoring.train(docs, docs)).collect()}
    assert found == {i: len(lm_scoring.words_of(t)) for i, t in enumerate(texts)}


def test_blocks_take_little_memory_beyond_their_tokens(spark):
    """What a Python worker holds at most to build a block and to deal it to groups, in bytes a token."""

    class Texts:
        def select(self, *columns):
            return self

        def mapInArrow(self, made, schema):
            return made

    random = np.random.default_rng(8)
    texts = [" ".join(f"w{int(x)}" for x in random.zipf(1.2, 400) % 50_000) for _ in range(1000)]
    batches = [pa.RecordBatch.from_pydict({"d": range(at, at + 100), "t": texts[at : at + 100]}) for at in range(0, 1000, 100)]
    made = lm_scoring._blocks(Texts(), 0)
    taken = []
    for step in (lambda: next(made(iter(batches))).to_pylist()[0], lambda: lm_scoring.Laid(row, deal)):
        tracemalloc.start()
        found = step()
        taken.append(tracemalloc.get_traced_memory()[1] / 400_000)
        tracemalloc.stop()
        if len(taken) == 1:
            row, deal = found, lm_scoring.Deal(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 4)
    assert found.sizes.sum() == len(found.tokens) == 400_000 and found.times.sum() == 400_000
    assert max(taken) < 38, taken
