"""Benchmark decontamination: containment search for short items in long documents, in Spark only.

Texts are cut into five-word shingles of lower-cased letters and figures. Items are partitioned by
their number of shingles into classes that double in size. A class with at most `u` shingles gets a
MinHash sketch of the `m = floor((1 - threshold) * u) + 1` smallest hash values of an item's
shingles: a document that contains the threshold's share of an item lacks fewer than `m` of its
shingles, so it holds at least one of the sketch, however long it is. Containment of short sets in
long ones is thus found without loss, where MinHash signatures of both sides would drown.

Documents look their distinct shingle hashes up in the sketches; whether the sketches are sent to all
tasks or both sides are shuffled is Spark's choice by the size of the written sketch table. Candidate
pairs are then verified on the shingles themselves: shared shingles / shingles of the item.

A text of one to four words has its whole sequence as its only shingle; documents then have windows of
the lengths below five that items have as well, so such an item is found inside a longer text. NULL,
empty and wordless texts have none and are in no pair. Documents of one id, NULL included, share one
finding per item; of items of one id the best match counts. Very long texts are looked up whole; empty
tables give no pairs. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.llm.common import whole_text, written

WIDTH = 5
THRESHOLD = 0.8


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(whole_text(text)), r"[^\p{L}\p{N}]+"), "")


def _windows(words: Column, width: int) -> Column:
    """Each window's words joined by blanks, in order; all words as one where they are fewer.

    Words are taken one by one: `slice` would copy the whole array for every window.
    """
    starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
    window = F.transform(starts, lambda i: F.concat_ws(" ", *[F.element_at(words, i + k) for k in range(width)]))
    return (
        F.when(F.size(words) >= width, window)
        .when(F.size(words) > 0, F.array(F.array_join(words, " ")))
        .otherwise(F.array().cast("array<string>"))
    )


def shingles(words: Column, width: int = WIDTH) -> Column:
    """Distinct shingles as text; a word holds no blank."""
    return F.array_distinct(_windows(words, width))


def document_windows(words: Column, width: int = WIDTH, short: tuple[int, ...] = ()) -> Column:
    """A document's shingles, and its windows of the lengths in `short`; some may repeat."""
    none = F.array().cast("array<string>")
    return F.concat(_windows(words, width), *[F.when(F.size(words) > n, _windows(words, n)).otherwise(none) for n in short])


def shingle_hashes(words: Column, width: int = WIDTH, short: tuple[int, ...] = ()) -> Column:
    """Distinct shingle hashes of a document."""
    return F.array_distinct(F.transform(document_windows(words, width, short), lambda s: F.xxhash64(s)))


def item_sketches(items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Items with their shingles, their words up to `width`, size class and sketch: item_id, shingles, n_words, size_class, sketch."""
    cut = (
        items.select("item_id", let(normal_words(F.col("text")), lambda words: F.struct(shingles(words, width).alias("shingles"), F.size(words).alias("n_words"))).alias("_i"))
        .select("item_id", "_i.shingles", F.least("_i.n_words", F.lit(width)).alias("n_words"))
        .where(F.size("shingles") > 0)
        .dropDuplicates()
    )
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles").cast("double"))))
    # The tiny term keeps (1 - 0.8) * 10 from falling below 2.
    kept = (F.floor((1 - threshold) * F.col("upper") + 1e-9) + 1).cast("int")
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    return cut.withColumn("upper", upper).select("item_id", "shingles", "n_words", F.col("upper").cast("long").alias("size_class"), F.slice(hashes, 1, kept).alias("sketch"))


def find(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """Pairs of documents and items they contain: doc_id, item_id, n_shared, n_item, containment."""
    sketched = written(item_sketches(items, threshold, width), "items")
    postings = written(sketched.select("item_id", F.explode("sketch").alias("h")).distinct(), "sketches")
    texts = docs.select("doc_id", "text")
    # The outer form: a plain explode would have Spark test the array in a filter, and make it twice.
    short = tuple(sorted(r["n_words"] for r in sketched.where(F.col("n_words") < width).select("n_words").distinct().collect()))
    hashes = let(normal_words(F.col("text")), lambda words: shingle_hashes(words, width, short))
    looked_up = texts.select("doc_id", F.explode_outer(hashes).alias("h"))
    pairs = written(looked_up.join(postings, "h").select("doc_id", "item_id").distinct(), "pairs")
    same_id = texts["doc_id"].eqNullSafe(pairs["doc_id"])
    same_item = pairs["item_id"].eqNullSafe(sketched["item_id"])
    verified = (
        texts.join(pairs, same_id)
        .join(sketched, same_item)
        .select(
            texts["doc_id"],
            pairs["item_id"],
            F.size(F.array_intersect("shingles", let(normal_words(F.col("text")), lambda words: document_windows(words, width, short)))).cast("long").alias("n_shared"),
            F.size("shingles").cast("long").alias("n_item"),
        )
        .where(F.col("n_shared") >= threshold * F.col("n_item") - 1e-9)
    )
    best = F.max_by(F.struct("n_shared", "n_item"), F.struct(F.col("n_shared") / F.col("n_item"), "n_shared")).alias("b")
    found = verified.groupBy("doc_id", "item_id").agg(best)
    return found.select("doc_id", "item_id", "b.n_shared", "b.n_item", (F.col("b.n_shared") / F.col("b.n_item")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """`docs` without those that contain an item, in their own columns.

    Rows are judged each by its own text, found by a hash of id and text, so a clean row stays where
    another of its id, NULL included, leaks.
    """
    row = F.xxhash64(F.col("doc_id"), whole_text())
    found = find(docs.select(row.alias("doc_id"), "text"), items, threshold, width)
    leaked = written(found.select(F.col("doc_id").alias("_leaked")).distinct(), "leaked")
    return docs.join(leaked, F.xxhash64(docs["doc_id"], whole_text(docs["text"])) == leaked["_leaked"], "left_anti")
