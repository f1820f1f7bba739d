"""Language-model scoring by cross-entropy difference.

Two word bigram models, of a target corpus and of the background (all documents), share one
vocabulary, one set of bigrams and one smoothing, so their losses per token can be compared. A
document's score is its mean loss under the target model less that under the background model: the
lower, the more it resembles the target.

All counts are taken over all texts of both corpora and all of them are kept. The texts are written once as blocks: the
hashes of a block's words and its texts as numbers of these. Each block sends its distinct words and bigrams with
their counts, packed, to groups that go by the hash of a word: a word and the bigrams that it begins are added up in one
group, which answers every block with the totals in the block's own order. So a bigram crosses the
network once for each block that holds it, as the hash of its second word, and only small counts come back; a text's
losses are added up where its block is. The `SENT_WORDS` most frequent words go by numbers in place of 63-bit hashes, and the bigrams of
the first `SPREAD` of them are dealt over all groups, so that no group gets a hot word whole; what these add up to is sent to
the tasks. That decides how things travel and not what they are. A group gets about `SENT_BIGRAMS` bigrams. The mass that
discounting takes from the bigrams (absolute discounting) goes to the unigrams, so each model is a distribution over the
words and one unknown word.

Callers that name `size` or `bigrams` get a small model instead that is held on the driver: of the most
frequent words (others are one unknown word) and bigrams, each cut at a count, so equals stay or go
together.

NULL, empty and wordless texts have no tokens, and losses and score 0. Texts of any length count and are
scored whole. Repeated rows count and are scored each on their own. Without target texts the target model
is uniform over the vocabulary; without documents nothing is scored, and a model of no texts at all gives
every word the share of the unknown one. Columns named like the outputs are replaced, all others kept.
"""

from __future__ import annotations

import hashlib
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, fresh, give_back, whole_text, worker_cache, written
from newsloom.session import stage

SENT_WORDS = 1 << 17
SENT_BIGRAMS = 1 << 19
SPREAD = 1 << 11
OFTEN = 8
BLOCK_CHARS = 8_000_000
HELD_WORDS = 1 << 17
CACHED_WORDS = 60_000
DISCOUNT = 0.75
START, UNKNOWN = 0, 1

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    """Words between ASCII white space, in lower case by Python's rules; `vocabulary` lowers by those of the JVM, which
    differ for a few letters such as the dotted capital I."""
    return _WORD.findall(text.lower())


def count_cut(of_count: list[tuple[int, int]], limit: int) -> int:
    """The least count to keep so that at most `limit` things stay; `of_count` says how many have each count."""
    cut, taken = max((n for n, _ in of_count), default=0) + 1, 0
    for n, many in sorted(of_count, reverse=True):
        if taken + many > limit:
            break
        cut, taken = n, taken + many
    return cut


def _of_count(counts: DataFrame, column: str) -> list[tuple[int, int]]:
    return [(r[0], r[1]) for r in counts.groupBy(column).agg(F.count("*")).collect()]


def vocabulary(texts: DataFrame, size: int) -> dict[str, int]:
    """Numbers of the most frequent words of all texts (column `t`), from 2 on, by count and then by word."""
    words = texts.select(F.explode(F.split(F.lower(F.col("t")), r"[\x20\x09-\x0D]+")).alias("w")).where(F.col("w") != "")
    counts = stage(words.groupBy("w").agg(F.count("*").alias("n")))
    top = counts.where(F.col("n") >= count_cut(_of_count(counts, "n"), size)).collect()
    return {r["w"]: i for i, r in enumerate(sorted(top, key=lambda r: (-r["n"], r["w"])), 2)}


def numbers(text: str, known: dict[str, int]) -> np.ndarray:
    words = words_of(text)
    return np.fromiter((known.get(w, UNKNOWN) for w in words), dtype=np.int64, count=len(words))


def bigram_keys(ids: np.ndarray, size: int) -> np.ndarray:
    """A bigram as previous word * size + word; a text begins after START."""
    before = np.concatenate([np.array([START], dtype=np.int64), ids[:-1]]) if len(ids) else ids
    return before * size + ids


@dataclass
class Model:
    """Log probabilities: of kept bigrams, and of words with the mass that is left after a word."""

    known: dict[str, int]
    size: int
    keys: np.ndarray
    bigram: dict[str, np.ndarray]
    unigram: dict[str, np.ndarray]
    left: dict[str, np.ndarray]

    def losses(self, text: str) -> tuple[int, float, float]:
        """Tokens, and the mean loss of a token under the target and the background model."""
        ids = numbers(text, self.known)
        if not len(ids):
            return 0, 0.0, 0.0
        keys = bigram_keys(ids, self.size)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        kept = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        means = []
        for which in ("target", "background"):
            p = self.left[which][keys // self.size] * self.unigram[which][ids]
            if len(self.keys):
                p = p + np.where(kept, self.bigram[which][at], 0)
            means.append(float(-np.log(p).mean()))
        return len(ids), means[0], means[1]


@dataclass
class Counts:
    """All counts: blocks of texts, what their words and bigrams add up to over all blocks, and the totals of these."""

    blocks: DataFrame
    texts: DataFrame
    deal: Deal
    totals: DataFrame
    tokens: dict[str, int]
    size: int
    spread: dict[int, tuple[int, int]]

    @property
    def bigrams(self) -> DataFrame:
        """Each bigram once, by the ids of its words, with its counts."""
        return _sent(self.blocks, self.deal).groupBy("p").applyInArrow(_distinct, "a bigint, b bigint, background bigint, target bigint")


@dataclass
class Deal:
    """How words are named and dealt: the hashes of the frequent ones, sorted, with their numbers from 1; and the number of groups."""

    frequent: np.ndarray
    numbers: np.ndarray
    groups: int

    def ids(self, words: np.ndarray) -> np.ndarray:
        """A frequent word's number, any other's (negative) hash, and START for itself."""
        if not len(self.frequent):
            return words
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, self.numbers[at], words)

    def group(self, ids: np.ndarray) -> np.ndarray:
        return ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(self.groups)).astype(np.int64)


def hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words, all negative; those of the words met first are kept from block to block."""
    found, known = np.empty(len(words), dtype=np.int64), worker_cache("hashes", dict)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True) | -(1 << 63)
            if len(known) < CACHED_WORDS:
                known[w] = h
        found[i] = h
    return found


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them, compressed."""
    least = np.result_type(np.min_scalar_type(numbers.min(initial=0)), np.min_scalar_type(numbers.max(initial=0)))
    held = numbers.astype(least).tobytes()
    return least.str.encode() + len(held).to_bytes(8, "little") + pa.compress(held, codec="zstd", asbytes=True)


def _unpacked(held: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(pa.decompress(held[11:], int.from_bytes(held[3:11], "little"), codec="zstd"), dtype=held[:3].decode()).astype(kind)


_BLOCK = "block bigint, corpus int, pairs bigint, docs binary, sizes binary, words binary, tokens binary"


def _run(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a run's distinct words, and its words as places in these; the words themselves are not kept."""
    coded = pa.array(words, type=pa.binary()).dictionary_encode()
    return hashes(coded.dictionary.to_pylist()), coded.indices.to_numpy()


def _block(runs: list[tuple[np.ndarray, np.ndarray]], sizes: list[int], docs: list[int], corpus: int) -> pa.RecordBatch:
    """The words of texts as numbers, START first and then the most frequent ones."""
    words, place = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(h for h, _ in runs)]), return_inverse=True)
    ends, sizes = np.cumsum([0, *(len(h) for h, _ in runs)]), np.array(sizes, dtype=np.int64)
    order = np.argsort(-np.bincount(np.concatenate([np.zeros(0, dtype=np.int64), *(place[a + c] for a, (_, c) in zip(ends, runs))]), minlength=len(words)), kind="stable")
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(1, len(order) + 1)
    words, rank = np.concatenate([np.array([START], dtype=np.int64), words[order]]), rank[place]
    tokens = np.concatenate([np.zeros(0, dtype=np.int32), *(rank[a + c] for a, (_, c) in zip(ends, runs))])
    pairs = int(np.count_nonzero(_first_of(_sorted_pairs(sizes, tokens, len(words)))))
    columns = [[uuid.uuid4().int >> 65], [corpus], [pairs], [np.array(docs, dtype=np.int64).tobytes()], *([_packed(x)] for x in (sizes, words, tokens))]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4])], names=[c.split()[0] for c in _BLOCK.split(", ")])


def _pairs(sizes: np.ndarray, tokens: np.ndarray, width: int) -> np.ndarray:
    """Each token's bigram as previous word * width + word; a text begins after START."""
    pairs = np.zeros(len(tokens), dtype=np.int64)
    pairs[1:] = tokens[:-1]
    pairs[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
    pairs *= width
    pairs += tokens
    return pairs


def _sorted_pairs(sizes: np.ndarray, tokens: np.ndarray, width: int) -> np.ndarray:
    pairs = _pairs(sizes, tokens, width)
    pairs.sort()
    return pairs


def _first_of(values: np.ndarray) -> np.ndarray:
    """Which of sorted values are the first of their kind."""
    first = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return first


def _blocks(texts: DataFrame, corpus: int) -> DataFrame:
    """Blocks of about `BLOCK_CHARS` characters of the texts (column `t`)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, words, sizes, docs, chars = [], [], [], [], 0
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = t.as_py()
                own = text.lower().encode("utf-8", "surrogatepass").split()
                words += own
                sizes.append(len(own))
                docs.append(d)
                chars += len(text)
                if len(words) >= HELD_WORDS or chars >= BLOCK_CHARS:
                    runs.append(_run(words))
                    words = []
                if chars >= BLOCK_CHARS:
                    yield _block(runs, sizes, docs, corpus)
                    runs, sizes, docs, chars = [], [], [], 0
                    give_back()
        if docs:
            yield _block([*runs, _run(words)], sizes, docs, corpus)
        give_back()

    return texts.select(F.xxhash64("t").alias("d"), "t").mapInArrow(made, _BLOCK)


class Laid:
    """A block's words and bigrams as they are dealt to groups.

    A word, with its counts, goes to a group by its id, and the bigrams that it begins go there too. Those of the
    `SPREAD` most frequent words and of START are dealt by the whole bigram, under an entry of the word in each group.
    """

    def __init__(self, row: dict, deal: Deal) -> None:
        self.sizes, words = (_unpacked(row[c]) for c in ("sizes", "words"))
        self.tokens = _unpacked(row["tokens"], np.int32)
        self.ids, self.width = deal.ids(words), len(words)
        pairs = _sorted_pairs(self.sizes, self.tokens, self.width)
        first = np.flatnonzero(_first_of(pairs))
        self.pairs, self.times = pairs[first], np.diff(first, append=len(pairs)).astype(np.int32)
        del pairs, first
        self.a = (self.pairs // self.width).astype(np.int32)
        self.b = (self.pairs % self.width).astype(np.int32)
        home = deal.group(self.ids)
        cells = home[self.a]
        some = np.flatnonzero(((self.ids >= 0) & (self.ids <= SPREAD))[self.a])
        cells[some] = deal.group(self.ids[self.a[some]] * 0x5851F42D4C957F2D ^ self.ids[self.b[some]])
        cells *= self.width
        cells += self.a
        self.order = np.argsort(cells, kind="stable").astype(np.int32)
        cells = cells[self.order]
        first = np.flatnonzero(_first_of(cells))
        runs, cells = np.diff(first, append=len(cells)), cells[first]
        self.entries = np.unique(np.concatenate([home * self.width + np.arange(self.width), cells]))
        self.runs = np.zeros(len(self.entries), dtype=np.int64)
        self.runs[np.searchsorted(self.entries, cells)] = runs
        self.group, self.word = self.entries // self.width, self.entries % self.width
        self.at_home = home[self.word] == self.group
        self.groups, first = np.unique(self.group, return_index=True)
        self.edges = np.append(first, len(self.entries))
        self.pair_edges = np.concatenate([[0], np.cumsum(self.runs)])[self.edges]


_SENT = "p bigint, block bigint, corpus int, names binary, runs binary, counts binary, after binary, times binary"


def _sent(blocks: DataFrame, deal: Deal) -> DataFrame:
    """For each block and group the ids and counts of words, and after each the bigrams that it begins."""
    shared = blocks.sparkSession.sparkContext.broadcast(deal)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                laid = Laid(row, shared.value)
                names, after, times = laid.ids[laid.word], laid.ids[laid.b[laid.order]], laid.times[laid.order]
                first = np.bincount(laid.a, weights=laid.times, minlength=laid.width).astype(np.int64)
                counts = [np.where(laid.at_home, n[laid.word], 0) for n in (np.bincount(laid.tokens, minlength=laid.width), first)]
                made = []
                for n, p in enumerate(laid.groups.tolist()):
                    own, pairs = slice(*laid.edges[n : n + 2]), slice(*laid.pair_edges[n : n + 2])
                    made.append([p, row["block"], row["corpus"], *map(_packed, (names[own], laid.runs[own], np.concatenate([c[own] for c in counts]), after[pairs], times[pairs]))])
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*made), [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5])], names=[c.split()[0] for c in _SENT.split(", ")])
                del laid, names, after, times, first, counts, made
                give_back()

    return blocks.mapInArrow(rows, _SENT)


class Met:
    """What the blocks sent to one group: each word and each bigram once, with its counts in both corpora."""

    def __init__(self, rows: pa.Table) -> None:
        self.rows = rows.to_pylist()
        names, runs, counts, after, times = ([_unpacked(r[c]) for r in self.rows] for c in ("names", "runs", "counts", "after", "times"))
        self.words, self.word = np.unique(np.concatenate(names), return_inverse=True)
        self.many, self.pairs_many = [len(n) for n in names], [len(t) for t in times]
        self.follows, after = np.unique(np.concatenate(after), return_inverse=True)
        width = max(len(self.follows), 1)
        self.keys, self.pair = np.unique(np.repeat(self.word, np.concatenate(runs)) * width + after, return_inverse=True)
        self.a, self.b = self.keys // width, self.keys % width
        corpus = [r["corpus"] for r in self.rows]
        sums = lambda of, size, values, many: [np.bincount(of, weights=np.concatenate([v * (c == k) for v, c in zip(values, corpus)]), minlength=size).astype(np.int64) for k in (0, 1)]
        self.counts = sums(self.pair, len(self.keys), times, self.pairs_many)
        self.own = sums(self.word, len(self.words), [c[: len(c) // 2] for c in counts], self.many)
        self.before = sums(self.word, len(self.words), [c[len(c) // 2 :] for c in counts], self.many)
        self.next = [np.bincount(self.a, weights=n > 0, minlength=len(self.words)).astype(np.int64) for n in self.counts]


def _distinct(rows: pa.Table) -> pa.Table:
    met = Met(rows)
    kept = (met.counts[0] > 0) | (met.counts[1] > 0)
    columns = [met.words[met.a], met.follows[met.b], *met.counts]
    return pa.table({n: c[kept] for n, c in zip(("a", "b", "background", "target"), columns)})


_TOTALS = "p bigint, block bigint, names binary, pair_counts binary, distinct bigint, background bigint, target bigint"


def _answered(rows: pa.Table, corpus: int) -> pa.Table:
    """To each block of a corpus the counts of its words and bigrams over all blocks, in its order; and the group's own sums, as block -1."""
    met = Met(rows)
    p, made = met.rows[0]["p"], []
    words, pairs = np.stack([*met.own, *met.before, *met.next]), np.stack(met.counts)
    at, pair_at = np.cumsum([0, *met.many]), np.cumsum([0, *met.pairs_many])
    for n, row in ((n, row) for n, row in enumerate(met.rows) if row["corpus"] == corpus):
        own, own_pairs = met.word[at[n] : at[n + 1]], met.pair[pair_at[n] : pair_at[n + 1]]
        made.append([p, row["block"], _packed(words[:, own].reshape(-1)), _packed(pairs[:, own_pairs].reshape(-1)), 0, 0, 0])
    spread = np.flatnonzero((met.words >= 0) & (met.words <= SPREAD))
    partial = np.concatenate([met.words[spread], *(n[spread] for n in met.next)])
    distinct = (met.words != START) & (met.own[0] + met.own[1] > 0)
    made.append([p, -1, _packed(partial), None, int(distinct.sum()), int(met.own[0].sum()), int(met.own[1].sum())])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 3]
    return pa.table({c.split()[0]: pa.array(v, type=t) for c, v, t in zip(_TOTALS.split(", "), zip(*made), kinds)})


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for held in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _unpacked(held).reshape(3, -1)], names=["w", "background", "target"])


def _counted(blocks: DataFrame, texts: DataFrame, corpus: int) -> Counts:
    """The counts of blocks, as answers to those of one corpus. Which words count as frequent decides how they are named and dealt and not what is counted."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, coded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, n = _unpacked(held), np.bincount(_unpacked(coded))
                some = np.flatnonzero(n >= OFTEN)
                yield pa.RecordBatch.from_arrays([pa.array(words[some]), pa.array(n[some])], names=["w", "n"])

    counts = written(blocks.select("words", "tokens").mapInArrow(often, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n")), "words")
    top = counts.where(F.col("n") >= count_cut(_of_count(counts, "n"), SENT_WORDS)).toArrow()
    words, n = (top.column(c).to_numpy() for c in ("w", "n"))
    numbers = np.empty(len(words), dtype=np.int64)
    numbers[np.lexsort((words, -n))] = np.arange(1, len(words) + 1)
    order = np.argsort(words)
    pairs = blocks.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    deal = Deal(words[order], numbers[order], 1 + pairs // max(SENT_BIGRAMS, 1))
    totals = written(_sent(blocks, deal).groupBy("p").applyInArrow(lambda rows: _answered(rows, corpus), _TOTALS), "totals")
    own = totals.where("block = -1")
    names = ("distinct", "background", "target")
    found = own.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    spread = own.select("names").mapInArrow(_partials, "w bigint, background bigint, target bigint").groupBy("w").agg(F.sum("background"), F.sum("target")).collect()
    return Counts(blocks, texts, deal, totals, {c: found[c] for c in names[1:]}, found["distinct"], {r[0]: (r[1], r[2]) for r in spread})


def whole_counts(docs: DataFrame, target: DataFrame, text: str = "text") -> Counts:
    """All words and bigrams of both corpora."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(whole_text(text).alias("t"))
    blocks = written(_blocks(texts, 0).unionByName(_blocks(target.select(whole_text(text).alias("t")), 1)), "blocks")
    return _counted(blocks, texts, 0)


def _score_by_counts(docs: DataFrame, model: Counts, text: str) -> DataFrame:
    """Columns `d`, the hash of a text, and `n_tokens`, `target_loss` and `background_loss` of it."""
    texts, corpus = docs.select(whole_text(text).alias("t")), 0
    if not texts.sameSemantics(model.texts):  # others may hold bigrams that were never counted
        corpus = 2
        model = _counted(written(model.blocks.where("corpus < 2").unionByName(_blocks(texts, corpus)), "blocks"), texts, corpus)
    tokens, size, spread = model.tokens, model.size, model.spread
    shared = docs.sparkSession.sparkContext.broadcast(model.deal)
    names = ["d", "n_tokens", "target_loss", "background_loss"]

    def rows(held: pa.Table) -> pa.Table:
        give_back()
        held = held.to_pylist()
        row = next(r for r in held if r["tokens"] is not None)
        answers = sorted((r for r in held if r["tokens"] is None), key=lambda r: r["p"])
        laid = Laid(row, shared.value)
        words, pairs = np.zeros((6, laid.width), dtype=np.int64), np.empty((2, len(laid.pairs)), dtype=np.int64)
        # One answer at a time, at its place in the block's order.
        at = pair_at = 0
        for r in answers:
            of_words, of_pairs = _unpacked(r["names"]).reshape(6, -1), _unpacked(r["pair_counts"]).reshape(2, -1)
            own = slice(at, at := at + of_words.shape[1])
            words[:, laid.word[own][laid.at_home[own]]] = of_words[:, laid.at_home[own]]
            pairs[:, laid.order[pair_at : (pair_at := pair_at + of_pairs.shape[1])]] = of_pairs
        for at in np.flatnonzero((laid.ids >= 0) & (laid.ids <= SPREAD)).tolist():
            words[4:, at] = spread[int(laid.ids[at])]
        text_of = np.repeat(np.arange(len(laid.sizes)), laid.sizes)
        place = np.searchsorted(laid.pairs, _pairs(laid.sizes, laid.tokens, laid.width))
        means = []
        for n, which in ((1, "target"), (0, "background")):
            own, before, following = words[n], words[2 + n], words[4 + n]
            unigram = (own + 1.0) / float(tokens[which] + size + 1)
            left = np.where(before > 0, np.maximum(following * DISCOUNT / np.maximum(before, 1), 1e-6), 1.0)
            p = np.maximum(pairs[n] - DISCOUNT, 0) / np.maximum(before, 1)[laid.a] + left[laid.a] * unigram[laid.b]
            means.append(np.bincount(text_of, weights=-np.log(p)[place], minlength=len(laid.sizes)) / np.maximum(laid.sizes, 1))
        return pa.table(dict(zip(names, (np.frombuffer(row["docs"], dtype=np.int64), laid.sizes, *means))))

    parts = model.blocks.where(F.col("corpus") == corpus).drop("pairs").unionByName(model.totals.where("block >= 0").select("p", "block", "names", "pair_counts"), allowMissingColumns=True)
    found = parts.groupBy("block").applyInArrow(rows, "d bigint, n_tokens bigint, target_loss double, background_loss double")
    return found.groupBy("d").agg(*[F.min(n).alias(n) for n in names[1:]])


def train(docs: DataFrame, target: DataFrame, text: str = "text", size: int | None = None, bigrams: int | None = None) -> Counts | Model:
    """The models of `target` and of the background `docs`, both with a column of texts.

    They hold all words and bigrams, unless the caller asks for a small one by `size` or `bigrams`.
    """
    if size is None and bigrams is None:
        return whole_counts(docs, target, text)
    spark = docs.sparkSession
    bounded_batches(spark)
    both = docs.select(whole_text(text).alias("t"), F.lit(False).alias("m")).unionByName(target.select(whole_text(text).alias("t"), F.lit(True).alias("m")))
    known = vocabulary(both, sys.maxsize if size is None else size)
    width = len(known) + 2
    shared = spark.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=bool)]
            for value, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = bigram_keys(numbers(value, shared.value), width)
                keys.append(own)
                marks.append(np.full(len(own), mark))
            unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, minlength=len(unique))
            ours = np.bincount(inverse[np.concatenate(marks)], minlength=len(unique))
            columns = [pa.array(unique), pa.array((total - ours).astype(np.int64)), pa.array(ours.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "background", "target"])

    parts = both.mapInArrow(count, "key bigint, background bigint, target bigint")
    counts = stage(parts.groupBy("key").agg(F.sum("background").alias("background"), F.sum("target").alias("target")))
    by_word = counts.groupBy((F.col("key") % width).alias("w")).agg(F.sum("background").alias("background"), F.sum("target").alias("target")).collect()
    by_before = counts.groupBy(F.floor(F.col("key") / width).alias("w")).agg(F.sum("background").alias("background"), F.sum("target").alias("target")).collect()
    total = counts.withColumn("n", F.col("background") + F.col("target"))
    kept = total.where(F.col("n") >= count_cut(_of_count(total, "n"), sys.maxsize if bigrams is None else bigrams)).drop("n").toArrow()
    order = np.argsort(kept.column("key").to_numpy())
    keys = kept.column("key").to_numpy()[order]
    model = Model(known, width, keys, {}, {}, {})
    for which in ("target", "background"):
        words, before = np.zeros(width), np.zeros(width)
        for rows, into in ((by_word, words), (by_before, before)):
            for r in rows:
                into[r["w"]] = r[which]
        seen = np.ones(width)
        seen[START] = 0
        model.unigram[which] = (words + seen) / (words + seen).sum()
        own = np.maximum(kept.column(which).to_numpy()[order] - DISCOUNT, 0)
        model.bigram[which] = own / np.maximum(before[keys // width], 1)
        model.left[which] = np.maximum(1 - np.bincount(keys // width, weights=model.bigram[which], minlength=width), 1e-6)
    return model


def score(docs: DataFrame, model: Counts | Model, text: str = "text") -> DataFrame:
    """`docs` with n_tokens, target_loss, background_loss and their difference; such columns are replaced.

    By a model of all counts, equal texts are found by a 64-bit hash of the text and scored together.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    names = ["n_tokens", "target_loss", "background_loss"]
    held = fresh(docs.columns, "_losses")
    if isinstance(model, Counts):
        key = fresh([*docs.columns, held], "_text")
        found = _score_by_counts(docs, model, text).select(F.col("d").alias(key), F.struct(*names).alias(held))
        with_losses = docs.withColumn(key, F.xxhash64(whole_text(text))).join(found, key, "left").drop(key)
    else:
        shared = spark.sparkContext.broadcast(model)

        @F.arrow_udf("struct<n_tokens:bigint,target_loss:double,background_loss:double>")
        def losses(column: pa.Array) -> pa.Array:
            found = [shared.value.losses(t or "") for t in column.to_pylist()]
            kinds = (pa.int64(), pa.float64(), pa.float64())
            return pa.StructArray.from_arrays([pa.array([f[i] for f in found], type=k) for i, k in enumerate(kinds)], names=names)

        with_losses = docs.withColumn(held, losses(whole_text(text)))
    out = with_losses.withColumns({n: F.col(held)[n] for n in names}).drop(held)
    return out.withColumn("cross_entropy_difference", F.col("target_loss") - F.col("background_loss"))
