import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import quality_classifier, quality_rules
from newsloom.llm.common import fold_remainder
from newsloom.llm.workload import QUERIES, labelled

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def check(rows, docs):
    by_id = Counter()
    for r in rows:
        by_id[r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]] += 1
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    assert by_id == Counter((r["doc_id"], *brute(r["text"])) for r in docs.collect())


def test_counts_by_brute_force(spark, awkward, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(QUERIES["op6_quality_rules"](spark, SF).collect(), docs)
    check(quality_rules.judge(awkward).collect(), awkward)
    assert quality_rules.judge(empty).collect() == []
    odd = [(1, "a b c a b c a"), (2, "x\ny\nx\n\n  \nx"), (3, "a a a a"), (4, "a b"), (5, "# * $ |<>&%"), (6, "q w e r q w e t q w")]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    check(quality_rules.judge(frame).collect(), frame)


def test_verdict_keeps_good_and_drops_bad(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "quality AS label")
    rows = QUERIES["op6_quality_rules"](spark, SF).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] for r in rows if r["label"] == 1]) > 0.99
    assert np.mean([r["kept"] for r in rows if r["label"] == 0]) < 0.5


def test_accuracies_are_found(spark):
    """Three rules that are right at known rates; the estimates come close to them."""
    random = np.random.default_rng(1)
    good = random.random(6000) < 0.7
    votes = {}
    for name, right in (("a", 0.95), ("b", 0.85), ("c", 0.75)):
        said = np.where(random.random(6000) < right, good, ~good)
        votes[name] = np.where(random.random(6000) < 0.8, np.where(said, 1, -1), 0)
    rows = list(zip(*(v.tolist() for v in votes.values())))
    trust = quality_rules.estimate(spark.createDataFrame(rows, "a int, b int, c int"), ["a", "b", "c"])
    for name in votes:
        for vote in (-1, 1):
            cast = votes[name] == vote
            true = (good[cast] == (vote == 1)).mean()
            assert abs(trust.accuracy(name, vote) - true) < 0.12, (name, vote, trust.votes[name], true)


def test_classifier_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_quality_classifier"](spark, SF).collect() if r["doc_id"] in labels and r["held_out"]]
    assert len(rows) > 80
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) >= 0.95


def test_compiled_rules_equal_the_numpy_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(fold_remainder(F.col("doc_id"), 4) != 2).select("doc_id", "text")
    model = quality_classifier.train(labelled(docs, spark, SF, "quality"))
    assert model.rules and len(model.describe()) == len(model.rules)
    rows = quality_classifier.with_features(docs).withColumn("score", model.score()).collect()
    x = np.array([[r[f"f_{f}"] for f in quality_classifier.FEATURES] for r in rows])
    z = model.intercept + quality_classifier._holds(x, [r for r, _ in model.rules]) @ np.array([w for _, w in model.rules])
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-z)))


def test_classifier_edges(spark, awkward, empty):
    one = awkward.withColumn("quality", F.lit(1))
    model = quality_classifier.train(one)
    rows = quality_classifier.score(awkward.withColumn("f_words", F.lit("x")), model).collect()
    assert len(rows) == awkward.count()
    assert all(r["score"] > 0.99 for r in rows)
    none = quality_classifier.train(awkward.withColumn("quality", F.lit(None).cast("int")))
    assert {r["score"] for r in quality_classifier.score(awkward.withColumn("f_words", F.lit("x")), none).collect()} == {0.5}
    assert quality_classifier.score(empty, model).collect() == []
