import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import toxicity
from newsloom.llm.workload import QUERIES


def test_learns_words_and_stems(spark):
    random = np.random.default_rng(0)
    clean = ["mira", "tolo", "vane", "serit", "pola", "quen", "dastu", "lomer"]
    ends = ["en", "ung", "los", "ig", "ach", "er", "et", "um", "in", "or"]
    texts, labels = [], []
    for i in range(900):
        words = list(random.choice(clean, 60))
        if i % 3 == 0:
            words[random.integers(60)] = random.choice(["dolt", "grobian" + random.choice(ends[:5])])
        texts.append(" ".join(words)), labels.append(i % 3 == 0)
    net = toxicity.fit(texts, np.array(labels, dtype=float))
    scorer = toxicity.Scorer(net)
    new = ["mira dolt tolo " * 3, "tolo vane Grobianum pola", "vane tolo grobianor mira", "mira tolo vane pola", "serit quen unseen words dastu", ""]
    found = scorer.scores(new)
    assert (found[:3] > 0.5).all() and (found[3:] < 0.3).all(), found


def test_blocks_give_the_whole_texts_value(monkeypatch):
    random = np.random.default_rng(0)
    net = toxicity.fit(["ab cd ef gh " * 4, "xy zz ab " * 5] * 6, np.array([0.0, 1.0] * 6))
    text = " ".join(random.choice(["ab", "cd", "xy", "zz", "new"], 400))
    whole = toxicity.Scorer(net).pooled(text)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 7)
    assert np.allclose(toxicity.Scorer(net).pooled(text), whole, atol=1e-6)
    direct = []
    words = ["", ""] + toxicity.words_of(text) + ["", ""]
    vectors = np.array([net.embedding[toxicity.word_rows(w)].sum(axis=0) if w else np.zeros(toxicity.DIMENSION) for w in words])
    for width in toxicity.WIDTHS:
        values = [sum(vectors[t + i] @ net.filters[width][i] for i in range(width)) for t in range(len(words) - width + 1)]
        direct.append(np.maximum(np.max(values, axis=0) + net.bias[width], 0))
    assert np.allclose(whole, np.concatenate(direct), atol=1e-4)


def test_held_out_table(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    hit = sum(r["predicted"] == 1 and labels[r["doc_id"]] == 1 for r in rows)
    assert hit / sum(labels[r["doc_id"]] for r in rows) > 0.85
    assert hit / sum(r["predicted"] for r in rows) > 0.85


def test_edges(spark, awkward, empty):
    only = toxicity.train(awkward.withColumn("toxic", F.lit(0)))
    rows = toxicity.flag(awkward, only).collect()
    assert len(rows) == awkward.count() and {r["score"] for r in rows} == {0.0} and not any(r["flagged"] for r in rows)
    mixed = toxicity.train(awkward.withColumn("toxic", (F.col("doc_id") % 2).cast("int")))
    assert all(0 <= r["score"] <= 1 and r["flagged"] is not None for r in toxicity.flag(awkward, mixed).collect())
    assert toxicity.flag(empty, mixed).collect() == []
    assert toxicity.train(empty.withColumn("toxic", F.lit(1))).embedding is None


def test_scores_keep_the_true_share_where_classes_are_sampled(spark, monkeypatch):
    """Texts that say nothing score the share of toxic rows, however few of the others are sampled."""
    monkeypatch.setattr(toxicity, "SAMPLE_PER_CLASS", 100)
    random = np.random.default_rng(1)
    rows = [(i, " ".join(random.choice(["mira", "tolo", "vane", "pola"], 12)), "en", int(i % 10 == 0)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    net = toxicity.train(docs)
    scores = toxicity.Scorer(net).scores([r[1] for r in rows])
    assert 0.04 < scores.mean() < 0.2, scores.mean()


def test_threshold_weighs_rows():
    values, labels = np.array([0.2, 0.2, 0.55, 0.3]), np.array([1, 1, 1, 0])
    assert toxicity.best_threshold(values, labels) <= 0.2
    assert toxicity.best_threshold(values, labels, np.array([1, 1, 1, 50.0])) > 0.3


def test_classes_of_long_texts_only_are_learned(spark, monkeypatch):
    """Texts beyond the learned length are learned by windows and calibrated whole."""
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 1600)
    random = np.random.default_rng(4)
    rows = []
    for i in range(200):
        words = ["dolt" if i % 2 and k % 5 == 0 else w for k, w in enumerate(random.choice(["mira", "tolo", "vane", "pola"], 800))]
        rows.append((i, " ".join(words), "en", i % 2))
    net = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int"))
    scores = toxicity.Scorer(net).scores([r[1] for r in rows])
    assert scores[1::2].min() > scores[::2].max() and "en" in net.thresholds


def test_every_labelled_row_is_learned_whole(spark, monkeypatch):
    """More rows of a class than any fixed sample, and a text longer than any window, in several blocks, twice with one result."""
    made = []
    monkeypatch.setattr(toxicity, "written", lambda rows, purpose, f=toxicity.written: made.append((purpose, f(rows, purpose))) or made[-1][1])
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 30_000)
    random = np.random.default_rng(2)
    rows = [(i, " ".join([*random.choice(["mira", "tolo", "vane", "pola"], 5), *["dolt"] * (i % 2)]), "en", i % 2) for i in range(4600)]
    rows.append((4600, "mira " * 9000, "en", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    nets = [toxicity.train(docs) for _ in range(2)]
    blocks = [b.collect() for purpose, b in made if purpose == "blocks"]
    assert len(blocks[0]) > 4 and sum(len(r["labels"]) // 4 for r in blocks[0]) == len(rows)
    assert sum(len(r["numbers"]) // 4 for r in blocks[0]) == sum(len(r[1].split()) for r in rows)
    assert (nets[0].embedding == nets[1].embedding).all() and nets[0].thresholds == nets[1].thresholds
    scores = toxicity.Scorer(nets[0]).scores(["mira tolo dolt vane", "mira tolo vane pola"])
    assert scores[0] > 0.5 > scores[1]


def test_texts_are_shuffled_once_and_few_without_a_label(spark, monkeypatch):
    """However large the tables, keys and texts meet in the one shuffle that deals the blocks."""
    plans = []

    def recorded(rows, purpose, f=toxicity.written):
        plans.append((purpose, rows._jdf.queryExecution().executedPlan().toString()))
        return f(rows, purpose)

    monkeypatch.setattr(toxicity, "written", recorded)
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", 500)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"mira {'dolt' if i % 2 else 'tolo'} vane", "en") for i in range(300)] + [(7, "aaa", None), (7, "bbb", "en")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, i % 2) for i in range(0, 300, 3)] + [(7, 1), (9, 1), (9, 1), (999, 1), (None, 0)], "doc_id long, toxic int")
        net = toxicity.train(docs.join(labels, "doc_id"), texts=docs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    plan = dict(plans)["blocks"]
    assert "SortMergeJoin" not in plan, plan
    assert plan.count("Exchange hashpartitioning(cell") == 1, plan
    scores = toxicity.Scorer(net).scores(["mira dolt vane", "mira tolo vane"])
    assert scores[0] > scores[1]


def test_cached_words_are_bounded_and_right(monkeypatch):
    random = np.random.default_rng(5)
    net = toxicity.fit(["ab cd ef gh " * 4, "xy zz ab " * 5] * 6, np.array([0.0, 1.0] * 6))
    texts = [" ".join(f"w{''.join(random.choice(list('abcdeé'), 4))}" for _ in range(random.integers(1, 30))) for _ in range(80)]
    whole = toxicity.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 40)
    scorer = toxicity.Scorer(net)
    assert np.allclose(scorer.scores(texts), whole, atol=1e-6) and len(scorer.known) <= 40
