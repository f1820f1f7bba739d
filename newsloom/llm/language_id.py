"""Language identification by compression with one zstandard dictionary per language.

A language's dictionary is raw content: pieces of its labelled texts. A text is compressed in
chunks with every dictionary, and the language whose total is smallest is chosen. Chunks are short,
so that the dictionary and not the text's own beginning decides how well a chunk compresses.

Learned from a bounded sample: `SAMPLE_DOCS` documents per language in a fixed pseudo-random order, of
any length. Each text is cut into pieces in the tasks; its pieces follow a hashed order, so they come
from all over the text, and a piece that stands in several texts, such as a header that a source puts
before all of its own, is taken once. A dictionary is filled with one piece of every text in turn, up to
`DICTIONARY_BYTES`; the driver gets no more than that of a language.

Letters are those of Unicode's category L, in training and prediction alike. Texts that hold none, empty
and NULL ones get "und" and score 0. Without any learned language every text gets "und". A margin below
`MIN_MARGIN` is marked in `rejected`. Ties go to the first language by name. Very long texts are
compressed whole, chunk by chunk. Rows that repeat an id are learned once and predicted each; an empty
table gives no rows. Columns named like the outputs are replaced, all others kept.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterable

import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, bounded_sample, fresh, whole_text

SAMPLE_DOCS = 300
DICTIONARY_BYTES = 64 * 1024
PIECE = 240
CHUNK = 1500
LEVEL = 3
MIN_MARGIN = 0.01
UNKNOWN = "und"

_LETTERS, _ASCII_LETTERS = regex.compile(r"\p{L}+"), re.compile("[a-z]+")
_cached: dict[str, object] = {}


def normal_form(text: str) -> str:
    """Lower-case words of letters, joined by blanks: case, figures and signs tell no language."""
    lower = text.lower()
    return " ".join((_ASCII_LETTERS if lower.isascii() else _LETTERS).findall(lower))


def text_pieces(text: str, most: int) -> list[str]:
    """At most `most` distinct pieces of a text in a hashed order, a short last one behind the others."""
    form = normal_form(text)
    pieces = {form[at : at + PIECE] for at in range(0, len(form), PIECE)}
    return sorted(pieces, key=lambda p: (len(p) < PIECE, xxhash.xxh64_intdigest(p), p))[:most]


def filled(pieces: Iterable[str], size: int) -> bytes:
    """A dictionary's content from pieces in order, those that repeat left out."""
    taken, total = [], 0
    for piece in dict.fromkeys(pieces):
        if total >= size:
            break
        taken.append(piece.encode())
        total += len(taken[-1])
    return b" ".join(taken)[:size]


def dictionaries(texts_by_language: dict[str, list[str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary content: one piece of every text in turn, up to `size` bytes."""
    made = {}
    for language, texts in sorted(texts_by_language.items()):
        cut = [text_pieces(t, size) for t in texts]
        turns = max(map(len, cut), default=0)
        made[language] = filled((own[n] for n in range(turns) for own in cut if n < len(own)), size)
    return {language: content for language, content in made.items() if content}


def _pieces(text: Column) -> Column:
    most = DICTIONARY_BYTES // PIECE + 2

    @F.arrow_udf("array<string>")
    def cut(column: pa.Array) -> pa.Array:
        return pa.array([text_pieces(t or "", most) for t in column.to_pylist()], type=pa.list_(pa.string()))

    return cut(text)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """Dictionaries by language from the rows with a language and a letter in the text."""
    bounded_batches(labelled.sparkSession)
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    picked = usable.select(F.col(lang).alias("l"), F.col(text).alias("t"), F.col(doc_id).alias("d"))
    sample = bounded_sample(picked, "l", "d", SAMPLE_DOCS)
    cut = sample.select("l", "n", F.posexplode(_pieces(F.col("t"))).alias("turn", "piece"))
    once = cut.groupBy("l", "piece").agg(F.min(F.struct("turn", "n")).alias("at"))
    nth = F.row_number().over(Window.partitionBy("l").orderBy("at", "piece"))
    rows = once.withColumn("nth", nth).where(F.col("nth") <= DICTIONARY_BYTES // PIECE + 2).orderBy("l", "nth").collect()
    by_language: dict[str, list[str]] = {}
    for row in rows:
        by_language.setdefault(row["l"], []).append(row["piece"])
    return {language: filled(pieces, DICTIONARY_BYTES) for language, pieces in by_language.items()}


def compressors(model: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    # Words are short: matches of four bytes must count, and a lazy search finds the longer of two.
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=CHUNK, dict_size=DICTIONARY_BYTES, strategy=zstandard.STRATEGY_LAZY, min_match=4,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    made = []
    for language, content in model.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=settings)
        made.append((language, zstandard.ZstdCompressor(compression_params=settings, dict_data=raw)))
    return made


def classify(text: str, coders: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, float]:
    """Language, score and margin: how much larger the second-best encoding is, as a share of it."""
    form = normal_form(text)
    if not form or not coders:
        return UNKNOWN, 0.0, 0.0
    data = form.encode()
    chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
    sizes = sorted((sum(len(coder.compress(c)) for c in chunks), language) for language, coder in coders)
    best, language = sizes[0]
    margin = (sizes[1][0] - best) / sizes[1][0] if len(sizes) > 1 else 1.0
    per_chunk = [(size - best) / max(1, best) * 32 for size, _ in sizes]
    return language, 1.0 / sum(math.exp(-min(50.0, x)) for x in per_chunk), margin


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score`, `margin` and `rejected`; columns of these names are replaced."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    @F.arrow_udf("struct<lang_pred:string,score:double,margin:double>")
    def predict(column: pa.Array) -> pa.Array:
        if _cached.get("key") != key:
            _cached.update(key=key, coders=compressors(shared.value))
        found = [classify(t or "", _cached["coders"]) for t in column.to_pylist()]
        names = ("lang_pred", "score", "margin")
        kinds = (pa.string(), pa.float64(), pa.float64())
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], type=k) for i, k in enumerate(kinds)], names=list(names))

    held = fresh(docs.columns, "_found")
    return (
        docs.withColumn(held, predict(whole_text(text)))
        .withColumns({n: F.col(held)[n] for n in ("lang_pred", "score", "margin")} | {"rejected": F.col(held)["margin"] < MIN_MARGIN})
        .drop(held)
    )
