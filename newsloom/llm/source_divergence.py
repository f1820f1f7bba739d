"""How far the sources of a language differ in their words: hash-consed segment trees over term ids.

A term is a run of letters A to Z, lower-cased, and of characters beyond ASCII; a language keeps the
terms that `least_docs` of its documents hold. Each group (language, source) gives each kept term the
share p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two groups differ at a term by
floor((p - q)^2 / (p + q)).

Kept terms are dealt by hash into blocks of about `BLOCK_TERMS`; inside a block the terms of a language
are numbered by falling count. Over these ids each group has a segment tree of its counts, built from the leaves up; a
node is known by its two children alone, so equal subtrees of all groups of the block are one node.
Two groups are priced by walking both trees at once, level by level: equal pairs of nodes are kept once
with the number of their places, so a pair of leaves is priced once however often it occurs. Terms that
no group of a task holds are added by number, as their price is one value. A group's leading terms come
from the same leaves against the language's counts.

Texts are counted in the tasks that read them and only counts are shuffled: no task gets the texts of a
source, and a frequent term brings one row per task and source at most. Groups meet in tiles of about
`TILE_GROUPS`, so a task holds two tiles of one block, whatever the number of sources. The result has a
row for every pair of sources of a language, which is what it is for. Arithmetic is exact while the
occurrences of a language's terms stay below 9 * 10^15.

NULL text, language and source are read as ''. Every group that occurs is there, even without terms;
repeated rows are documents of their own, whole texts count whatever their length, an empty table gives
no rows. Other columns are not looked at, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, whole_text, written

LEAST_DOCS = 10
LEADING_TERMS = 10
BLOCK_TERMS = 4096
TILE_GROUPS = 64
SCALE = 1_000_000_000
#: Counts that a task holds before it passes them on, bytes of a text that are split at once, and pairs priced at once.
HELD_COUNTS = 400_000
BLOCK_BYTES = 1 << 20
PRICED_PAIRS = 256

#: A to Z in lower case, all other ASCII but a to z as a blank.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("d", pa.int64())])
_PRICED = pa.schema([("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.binary()), ("value", pa.int64()), ("width", pa.int64()), ("absent", pa.int64()), ("v", pa.int64())])


def term_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    data = data.translate(_LETTERS)
    at = 0
    while len(data) - at > BLOCK_BYTES:
        end = data.find(b" ", at + BLOCK_BYTES)
        if end < 0:
            break
        yield data[at:end].split()
        at = end
    yield data[at:].split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by language, source and term, of as many documents as the bound allows; a row with the empty term shows a group."""
    from collections import Counter

    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (places, docs) in groups.items():
            places[b""] = docs[b""] = 0
            rows = [[lang] * len(places), [source] * len(places), list(places), list(places.values()), [docs[t] for t in places]]
            yield pa.RecordBatch.from_arrays([pa.array(r, type=f.type) for r, f in zip(rows, _COUNTS)], schema=_COUNTS)
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(n).to_pylist() for n in ("lang", "source", "text"))):
            places, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(places), set()
            for terms in term_blocks(text):
                places.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(places) - before
            if held >= HELD_COUNTS:
                yield from passed_on()
                held = 0
    yield from passed_on()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """A row for each kept term that a group holds: lang, source, term, n, the language's `total`, and `first` on one row of each term.

    Each group also has a row with the empty term and n = 0.
    """
    bounded_batches(docs.sparkSession)
    plain = docs.select(whole_text(lang).alias("lang"), whole_text(source).alias("source"), whole_text(text).cast("binary").alias("text"))
    counted = plain.mapInArrow(_count, "lang string, source string, term binary, n bigint, d bigint").withColumn("term", F.col("term").cast("string"))
    # One exchange serves the sums and the windows of a term.
    summed = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    of_term = Window.partitionBy("lang", "term")
    wide = summed.withColumns({"docs": F.sum("d").over(of_term), "total": F.sum("n").over(of_term), "first": F.min("source").over(of_term)})
    group = F.col("term") == ""
    kept = wide.where(group | (F.col("docs") >= least_docs))
    return kept.select("lang", "source", "term", "n", "total", (~group & (F.col("first") == F.col("source"))).alias("first"))


def exact_share(count: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(10^9 * count / whole) by long division, three figures at a time, so that 64 bits are enough."""
    if not whole:
        return np.zeros_like(count)
    share, rest = count // whole, count % whole
    for _ in range(3):
        rest = rest * 1000
        share, rest = share * 1000 + rest // whole, rest % whole
    return 1 + share


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // np.maximum(p + q, 1)


class Forest:
    """The segment trees of all rows of a matrix of counts; equal subtrees are one node."""

    def __init__(self, counts: np.ndarray) -> None:
        self.values, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape)
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        # Places beyond the terms are leaves of their own kind, without a price.
        self.beyond = len(self.values)
        ids = np.pad(ids, ((0, 0), (0, width - ids.shape[1])), constant_values=self.beyond)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        size = self.beyond + 1
        while ids.shape[1] > 1:
            nodes, own = np.unique(ids[:, ::2] * size + ids[:, 1::2], return_inverse=True)
            self.levels.append((nodes // size, nodes % size))
            ids, size = own.reshape(ids.shape[0], -1), len(nodes)
        self.roots = ids[:, 0]

    def leaf_pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of trees: the distinct pairs of leaves under each, (pair, leaf, leaf, places)."""
        pair, a, b, places = np.arange(len(left)), self.roots[left], self.roots[right], np.ones(len(left), dtype=np.int64)
        for lower, upper in reversed(self.levels):
            pair, places = np.tile(pair, 2), np.tile(places, 2)
            a, b = np.concatenate([lower[a], upper[a]]), np.concatenate([lower[b], upper[b]])
            size = int(max(a.max(initial=0), b.max(initial=0))) + 1
            keys = (pair * size + a) * size + b
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
            at = order[first]
            pair, a, b = pair[at], a[at], b[at]
            places = np.add.reduceat(places[order], first) if len(first) else places[:0]
        return pair, a, b, places


def _leading(counts: np.ndarray, totals: np.ndarray, whole: int, whole_lang: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and prices of a group's `top` terms above the language's share; each pair of counts is priced once."""
    held = np.flatnonzero(counts)
    pairs, own = np.unique(np.stack([counts[held], totals[held]]), axis=1, return_inverse=True)
    p, q = exact_share(pairs[0] + 2, whole), exact_share(pairs[1] + 2, whole_lang)
    value = np.where(p > q, price(p, q), -1)[own.reshape(-1)]
    held, value = held[value >= 0], value[value >= 0]
    order = np.lexsort((held, -value))[:top]
    return held[order], value[order]


def price_block(rows: pa.Table, top: int = LEADING_TERMS) -> pa.Table:
    """The pairs of one or two tiles of groups over the terms of a block, and, for one tile, its groups' leading terms."""
    head = rows.filter(pa.compute.is_null(rows["term"])).to_pylist()
    body = rows.filter(pa.compute.is_valid(rows["term"]))
    lang, two = rows["lang"][0].as_py(), rows["ta"][0].as_py() != rows["tb"][0].as_py()
    head.sort(key=lambda r: r["source"])
    sources = {r["source"]: i for i, r in enumerate(head)}
    n, v, whole_lang = [r["n"] for r in head], head[0]["v"], head[0]["total"] + 2 * head[0]["v"]
    terms, term_of = np.unique(np.array(body["term"].to_pylist(), dtype=object), return_inverse=True) if len(body) else (np.zeros(0, dtype=object), np.zeros(0, dtype=np.int64))
    row_of = np.array([sources[s] for s in body["source"].to_pylist()], dtype=np.int64)
    counts, totals = np.zeros((len(head), len(terms)), dtype=np.int64), np.zeros(len(terms), dtype=np.int64)
    counts[row_of, term_of] = body["n"].to_numpy()
    totals[term_of] = body["total"].to_numpy()
    found: list[tuple] = []
    if not two:
        for i, r in enumerate(head):
            places, values = _leading(counts[i], totals, n[i] + 2 * v, whole_lang, top)
            found += [(lang, "term", r["source"], terms[t], x, None, None, v) for t, x in zip(places.tolist(), values.tolist())]
    if two:
        left, right = np.array([(i, j) for i in range(len(head)) for j in range(i + 1, len(head)) if head[i]["tile"] != head[j]["tile"]], dtype=np.int64).reshape(-1, 2).T
    else:
        left, right = np.triu_indices(len(head), 1)
    value = np.zeros(len(left), dtype=np.int64)
    absent = np.array([exact_share(np.array([2]), x + 2 * v)[0] for x in n])
    if len(terms) and len(left):
        forest = Forest(counts[:, np.argsort(-totals, kind="stable")])
        shares = np.stack([exact_share(forest.values + 2, x + 2 * v) for x in n])
        for at in range(0, len(left), PRICED_PAIRS):
            i, j = left[at : at + PRICED_PAIRS], right[at : at + PRICED_PAIRS]
            pair, a, b, places = forest.leaf_pairs(i, j)
            inside = (a != forest.beyond) & (b != forest.beyond)
            pair, a, b, places = pair[inside], a[inside], b[inside], places[inside]
            np.add.at(value, pair + at, price(shares[i[pair], a], shares[j[pair], b]) * places)
    none = price(absent[left], absent[right]).tolist()
    found += [
        (lang, "pair", head[i]["source"], head[j]["source"].encode(), x, len(terms), z, v)
        for i, j, x, z in zip(left.tolist(), right.tolist(), value.tolist(), none)
    ]
    return pa.Table.from_arrays([pa.array([f[k] for f in found], type=f_.type) for k, f_ in enumerate(_PRICED)], schema=_PRICED)


def _tile_pairs(tile: Column, tiles: int) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), F.lit(tiles - 1)), lambda u: F.struct(F.least(tile, u).alias("ta"), F.greatest(tile, u).alias("tb"))))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = LEADING_TERMS
) -> DataFrame:
    """lang, source, part, item, value and rank: `pair` rows for all other sources of the language, `term` rows for a group's `top` terms."""
    kept = written(term_counts(docs, lang, source, text, least_docs), "terms")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if("first").alias("v"), F.count_if(F.col("term") == "").alias("sources"))
    most = langs.agg(F.max("v").alias("v"), F.max("sources").alias("sources")).first()
    blocks, tiles = (max(1, -(-(most[c] or 0) // size)) for c, size in (("v", BLOCK_TERMS), ("sources", TILE_GROUPS)))
    tile = F.pmod(F.hash(F.lit("tile"), "source"), F.lit(tiles))
    block = F.pmod(F.xxhash64(F.lit("block"), "term"), F.lit(blocks)).cast("int")
    named = ["lang", "source", "term", "n", "total", "v", "tile", "block"]
    head = (
        groups.join(langs, "lang")
        .withColumns({"term": F.lit(None).cast("binary"), "tile": tile, "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
        .select(*named)
    )
    body = kept.where(F.col("term") != "").withColumns({"tile": tile, "block": block, "v": F.lit(None).cast("long")}).withColumn("term", F.col("term").cast("binary")).select(*named)
    dealt = head.unionByName(body).select("*", _tile_pairs(F.col("tile"), tiles).alias("_t")).select(*named, "_t.ta", "_t.tb")
    kind = "lang string, part string, source string, item binary, value bigint, width bigint, absent bigint, v bigint"
    priced = written(dealt.groupBy("lang", "block", "ta", "tb").applyInArrow(lambda rows: price_block(rows, top), kind).withColumn("item", F.col("item").cast("string")), "priced")
    whole = priced.where("part = 'pair'").groupBy("lang", "source", "item").agg(*(F.sum(c).alias(c) for c in ("value", "width")), F.max("absent").alias("absent"), F.max("v").alias("v"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = whole.select("lang", both.alias("_p"), (F.col("value") + (F.col("v") - F.col("width")) * F.col("absent")).alias("value")).select("lang", "_p.source", F.lit("pair").alias("part"), "_p.item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = priced.where("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)
