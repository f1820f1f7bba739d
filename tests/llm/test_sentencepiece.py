"""Encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from newsloom.llm import sentencepiece_codec as codec_module
from newsloom.llm.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ALPHABETS = ["ab ", "the  ", "abcdefghij  \n", "▁ a\n", "éèà ß", "日本 の", "0123 .,", "{}();\r\n \t", "aeiou nrst", "̀x e"]
ODD = ["", " ", "  ", "\n", "a\n\n b", "▁▁a", "<s>", "<0x0A>", "\x00", "日本語テキスト" * 20, "<|endoftext|> \x1c a\x85b", "hahahahaha", "x" * 500, "\r\n" * 5, "😀😀 a😀", " \n \n  x  \n"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=codec_module.default_model())


@pytest.fixture(scope="module")
def own():
    return codec_module.Codec(codec_module.default_model())


def wanted(library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    shown = library.decode(ids)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()


def random_texts(count, seed):
    chosen = random.Random(seed)
    for _ in range(count):
        letters = chosen.choice(ALPHABETS)
        yield "".join(chosen.choice(letters) for _ in range(chosen.randint(0, 60)))


def test_ids_are_those_of_the_library(library, own):
    blanks = [" " * n + "abc" + " " * (n // 2) for n in range(70)] + ["\n" + " " * n + "{" for n in range(40)]
    for text in [*ODD, *blanks, *random_texts(3000, 1)]:
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True), repr(text)


def test_any_ids_decode_as_in_the_library(library, own):
    chosen = random.Random(2)
    for _ in range(3000):
        ids = [chosen.choice([chosen.randint(0, 300), chosen.randint(0, 31999)]) for _ in range(chosen.randint(0, 9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_blocks_and_full_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(codec_module, "BLOCK_CHARS", 40)
    monkeypatch.setattr(codec_module, "CACHED_UNITS", 30)
    small = codec_module.Codec(codec_module.default_model())
    texts = [*ODD, *random_texts(300, 3), " ".join(random_texts(60, 4)), "a" + " " * 300 + "b" * 100]
    assert codec_module.digests(texts, small) == [wanted(library, t) for t in texts]


def test_query_and_round_trip(spark, library):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op13_sentencepiece"](spark, SF_DIR).collect()}
    assert found == {r["doc_id"]: wanted(library, r["text"] or "") for r in rows}


def test_awkward_and_empty(spark, awkward, empty, library):
    made = codec_module.digest(awkward.withColumnRenamed("spans", "N_Tokens"))
    assert [c for c in made.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    for r in made.collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == wanted(library, r["text"] or "")
    back = codec_module.decode(codec_module.encode(awkward, output="ids"), output="shown").collect()
    assert all(r["shown"] == (r["text"] or "") for r in back) and len(back) == awkward.count()
    assert codec_module.digest(empty).collect() == codec_module.encode(empty).collect() == []
    assert codec_module.decode(spark.createDataFrame([(None,)], "ids array<int>")).first()["text"] is None
