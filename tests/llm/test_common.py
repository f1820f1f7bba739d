import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsloom.llm import common, near_dedup, toxicity


def test_sample_is_the_first_of_the_order_and_numbers_few_keys(spark, monkeypatch):
    plans, plain = {}, common.written
    monkeypatch.setattr(common, "written", lambda rows, purpose: plans.update({purpose: rows._jdf.queryExecution().optimizedPlan().toString()}) or plain(rows, purpose))
    rows = spark.range(20_000).select(F.col("id").alias("d"), (F.col("id") % 10 == 0).cast("int").alias("y"), F.lit("t").alias("t"))
    got = {(r["y"], r["d"]) for r in common.bounded_sample(rows, "y", "d", 1500).collect()}
    order = rows.withColumn("o", common.sample_order(F.col("d"))).orderBy("o", "d").collect()
    want = {(y, r["d"]) for y in (0, 1) for r in [r for r in order if r["y"] == y][:1500]}
    assert got == want
    # All keys of a label never meet in one window: the numbered ones come through the cells.
    assert "LeftSemi" in plans["sample"]


def test_sample_of_all_rows(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (2, 0), (None, 1), (3, 1)], "d long, y int")
    assert sorted((r["y"], r["d"], r["n"]) for r in common.bounded_sample(rows, "y", "d", 10).collect())[-1] == (1, 3, 1)


def test_sample_takes_one_row_of_a_repeated_key(spark):
    rows = spark.createDataFrame([(7, 1, "b"), (7, 1, "a"), (7, 0, "c"), (8, 1, None), (8, 1, "z")], "d long, y int, t string")
    found = sorted((r["y"], r["d"], str(r["t"])) for r in common.bounded_sample(rows, "y", "d", 10).collect())
    assert found == [(0, 7, "c"), (1, 7, "a"), (1, 8, "None")]


def test_windows_of_long_texts(spark):
    long = "".join(chr(97 + i % 26) for i in range(10_000))
    rows = spark.createDataFrame([(1, "short"), (2, long), (3, None)], "d long, t string")
    found = {r["d"]: r["w"] for r in rows.select("d", common.windows(F.col("t"), F.col("d"), 800, 8).alias("w")).collect()}
    assert found[1] == "short" and found[3] in (None, "")
    parts = found[2].split(" ")
    assert len(parts) == 8 and all(len(p) == 100 and p in long for p in parts) and len({long.index(p) for p in parts}) > 3


def test_likely_keeps_every_key_and_few_others(spark):
    rows = spark.range(50_000).select(F.col("id").alias("d"), F.lit("x").alias("t"))
    keys = spark.range(0, 50_000, 9).select(F.col("id").alias("d"))
    found = {r["d"] for r in common.likely(rows, keys, "d", 5556).collect()}
    assert found.issuperset(range(0, 50_000, 9)) and len(found) < 12_000
    assert common.likely(rows, keys.where("false"), "d", 0).count() == 0


def test_a_worker_drops_what_it_no_longer_uses(monkeypatch):
    common.let_go()
    words = common.worker_cache("words", dict)
    assert common.worker_cache("words", dict) is words
    runs = common.worker_cache("runs", dict)  # of two in use none goes
    assert common.worker_cache("words", dict) is words and common.worker_cache("runs", dict) is runs
    monkeypatch.setattr(common, "IDLE_SECONDS", 0.0)
    common.worker_cache("ids", dict)  # another stage
    assert set(common._kept) == {"ids"}
    common.let_go()
    assert not common._kept


def test_freed_memory_goes_back():
    """Small pieces that were freed under one that stays are not held."""

    def mb():
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    pieces = [np.ones(2000) for _ in range(10_000)]
    held, last = mb(), pieces[-1]
    del pieces
    common.give_back()
    assert mb() < held - 100 and last[0] == 1


def test_training_begins_without_the_caches_of_other_stages(spark):
    near_dedup.shingle_set("some words of a text", 5)
    assert common._kept
    toxicity._made(pa.table({"cell": [0, 0], "d": [1, 1], "y": [1, None], "o": [3, None], "apart": [False, None], "t": [None, "a b"], "l": [None, "en"], "w": pa.array([None, None], type=pa.string())}))
    assert not common._kept
