"""The registered queries against SQL, and the pipeline's stages against brute force."""

import re

import pytest
from test_decontamination import shingles
from test_near_dedup import brute

import corpus_pipeline
from newsloom.llm import secret_scan, toxicity
from newsloom.llm.common import written
from newsloom.llm.workload import ORACLES, QUERIES, toxicity_network
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF_DIR), name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_all_queries_are_registered(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= names


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, docs
    net = toxicity_network(spark, docs, SF_DIR)
    scorer = toxicity.Scorer(net)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        given = [r.asDict() for r in kept.collect()]
        kept = written(stage(spark, kept, SF_DIR), name)
        rows = [r.asDict() for r in kept.collect()]
        ids = {r["doc_id"] for r in rows}
        if number < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns
        if name == "toxicity":
            want = {r["doc_id"] for r in given if scorer.scores([r["text"] or ""])[0] < net.thresholds.get(r["lang"], net.threshold)}
        elif name == "near_dedup":
            want = {d for d, (_, c) in brute([(r["doc_id"], r["text"]) for r in given], width=5).items() if d == c}
        elif name == "decontamination":
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            want = {r["doc_id"] for r in given if not any(i and len(i & shingles(r["text"])) >= 0.8 * len(i) for i in items)}
        else:
            want = {r["doc_id"] for r in given}
        if name == "secret_scan":
            before = {r["doc_id"]: r for r in given}
            for r in rows:
                found = secret_scan.find_in_block([before[r["doc_id"]]["text"]], secret_scan.RULES)[0]
                assert (r["text"] == before[r["doc_id"]]["text"]) == (not found)
                assert not re.search(r"[0-9a-f]{32,}", r["text"])
                assert r["n_chars"] == len(r["text"])
        assert ids == want, name
        if name == "packing":
            assert sum(r["length"] for r in rows if r["offset"] == 0 and r["length"] > 4096) == 0


def test_stages_take_awkward_and_empty_tables(spark, awkward, empty):
    for docs in (awkward, empty):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = written(stage(spark, kept, SF_DIR), name)
            assert kept.columns == docs.columns, name
        if docs is awkward:
            assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "10", "11", "2", "3", "4", "5", "8", "None", "None"])
        else:
            assert kept.count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).count() == sum(1 for r in kept.collect() if r["doc_id"] != 4) + (-(-_ids(kept) // 4096) if docs is awkward else 0)


def _ids(docs):
    from newsloom.llm.tokens import default_vocabulary, document_ids

    return sum(len(document_ids(r["text"], default_vocabulary())) // 4 for r in docs.collect() if r["doc_id"] == 4)
