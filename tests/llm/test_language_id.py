from pyspark.sql import functions as F

from newsloom.llm import language_id
from newsloom.llm.common import fold_remainder


def model_of(docs):
    return language_id.train(docs.where(fold_remainder(F.col("doc_id"), 3) != 1))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, model_of(docs)).where(fold_remainder(F.col("doc_id"), 3) == 1).select("lang", "lang_pred", "score").collect()
    assert len(found) > 250
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_and_unlearned(spark, awkward, empty):
    model = {"en": b"some words of a text that is english " * 9, "de": "ein deutscher satz der nichts bedeutet ".encode() * 9}
    rows = language_id.identify(awkward, model).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] == 0) == (not letters)
    assert {r["lang_pred"] for r in language_id.identify(awkward, {}).collect()} == {"und"}
    assert language_id.identify(empty, model).collect() == []
    assert language_id.train(empty) == {}


def test_language_is_not_read(spark):
    docs = spark.createDataFrame([(1, "ein deutscher satz der nichts bedeutet", "xx")], "doc_id long, text string, lang string")
    model = language_id.dictionaries({"en": ["some words of a text that is english"], "de": ["ein deutscher satz der nichts bedeutet"]})
    assert language_id.identify(docs, model).first()["lang_pred"] == "de"


def test_dictionaries_take_pieces_in_turn():
    made = language_id.dictionaries({"a": ["x" * 1000, "y" * 300]}, size=600)["a"]
    assert made.startswith(b"x" * 240 + b" " + b"y" * 240)
    assert len(made) <= 600


def test_letters_are_letters_only(spark):
    model = {"en": b"some words of a text that is english " * 9}
    texts = ["½", "²", "Ⅷ", "٣", "① 12", "_", "x²", "é", "日本"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
    assert [found[n] == "und" for n in range(9)] == [True] * 6 + [False] * 3
    assert language_id.train(docs.withColumn("lang", F.lit("en")).where("doc_id < 6")) == {}


def test_pieces_come_from_all_over_a_text_and_headers_once(spark):
    header = "license header line of the source " * 12
    rows = [(i, header + " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + j // 676)}" for j in range(3000)), "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    made = language_id.train(docs)["en"].decode(errors="ignore")
    assert made.count("license header line") * 35 < len(made) / 10  # each text begins with 420 characters of it
    places = [rows[0][1].lower().find(p[:20]) for p in language_id.text_pieces(rows[0][1], 50)]
    assert max(places) > len(rows[0][1]) // 2
    assert "zz" not in language_id.train(spark.createDataFrame([(1, "ab " * 20_000, "zz")], "doc_id long, text string, lang string"))["zz"].decode()


def test_predictions_by_brute_force(spark):
    """The smallest sum of compressed chunk sizes decides, computed here with a compressor per call."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = model_of(docs)
    settings = zstandard.ZstdCompressionParameters.from_level(
        language_id.LEVEL, source_size=language_id.CHUNK, dict_size=language_id.DICTIONARY_BYTES, strategy=zstandard.STRATEGY_LAZY, min_match=4,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    raw = {k: zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for k, v in model.items()}
    for r in language_id.identify(docs, model).select("text", "lang_pred").limit(60).collect():
        data = language_id.normal_form(r["text"] or "").encode()
        chunks = [data[i : i + language_id.CHUNK] for i in range(0, len(data), language_id.CHUNK)]
        sizes = {k: sum(len(zstandard.ZstdCompressor(compression_params=settings, dict_data=raw[k]).compress(c)) for c in chunks) for k in model}
        assert r["lang_pred"] == (min(sizes, key=lambda k: (sizes[k], k)) if chunks else "und")
