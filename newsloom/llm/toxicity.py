"""Toxicity by a small convolutional text classifier over hashed word embeddings.

Words are runs of letters in lower case. A word's embedding is the sum of the hashed table rows of
the word itself and of its five-letter parts with marked ends, so that inflected forms share what
their stem has learned. Filters of several widths slide over the whole text, each keeps its largest
value, and a logistic layer scores these.
It learns from all labelled rows and their whole texts, in the tasks: the rows are dealt by a hash of their
id into blocks of about `BLOCK_CHARS` characters, each epoch (`EPOCHS` over one block, fewer over many) trains the network in every block on its own,
and the blocks' networks are averaged by Spark, a table row of the embedding over the blocks that moved it.
The driver sees one network per epoch, whatever the input. Sums are of whole numbers, so their order does
not matter. Embeddings start near zero, so
words that training never met say nothing. For scoring, each filter position is multiplied into the
table once; a convolution is then a sum of table rows. Texts are learned and scored whole, in blocks of words
whose edges overlap, so memory does not grow with a text.

Thresholds are chosen per language on the fifth of the labelled rows that training leaves out, which are
scored in the tasks and counted between the thresholds to choose from; languages with few such positives,
unknown and NULL ones use the overall threshold. Language is no input of a score.

Callers may set `SAMPLE_PER_CLASS` (rows of a class in a fixed pseudo-random order; weights restore the true shares)
or `SAMPLE_CHARS` (longer texts are learned by windows at hashed places); nothing does so by default.

NULL, empty and wordless texts score as a text whose filters are all at rest. NULL labels are left
out, and a row with several labels counts as toxic if one of them says so. Without both classes the
score is the share of toxic rows. Rows that repeat an id are learned once and scored each; an empty
table gives no rows. Columns named like the outputs are replaced, all others kept.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import ORDER_SHIFT, bounded_batches, let_go, likely, sample_order, whole_text, windows, worker_cache, written

SAMPLE_PER_CLASS: int | None = None
SAMPLE_CHARS: int | None = None
BLOCK_CHARS = 8_000_000
BUCKETS = 1 << 16
PART = 5
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
EPOCHS, LEAST_EPOCHS = 8, 3
RATE = 0.05
BATCH = 16
BLOCK_WORDS = 1 << 15
CACHED_WORDS = 60_000
CALIBRATION_SHARE = 5
LEAST_POSITIVES = 20
DEFAULT_THRESHOLD = 0.3
THRESHOLD_RANGE = (0.1, 0.6)
THRESHOLDS = np.arange(THRESHOLD_RANGE[0], THRESHOLD_RANGE[1] + 0.001, 0.05)
SEED = 7
# Averages of blocks are taken of whole multiples of 1 / SCALE.
SCALE = float(1 << 30)
SHAPES = {"w": (len(WIDTHS) * FILTERS,), "i": (1,), **{w: (w, DIMENSION, FILTERS) for w in WIDTHS}, **{-w: (FILTERS,) for w in WIDTHS}}

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_rows(word: str) -> list[int]:
    """The table rows of a word and of its parts, from 1 on; row 0 is the margin beyond either end."""
    marked = f"<{word}>"
    if marked.isascii():
        held = marked.encode()
        parts = [held, *(held[i : i + PART] for i in range(len(held) - PART + 1))]
    else:
        parts = [p.encode() for p in (marked, *(marked[i : i + PART] for i in range(len(marked) - PART + 1)))]
    return [zlib.crc32(p) % (BUCKETS - 1) + 1 for p in parts]


@dataclass
class Network:
    prior: float = 0.0
    embedding: np.ndarray | None = None
    filters: dict[int, np.ndarray] = field(default_factory=dict)
    bias: dict[int, np.ndarray] = field(default_factory=dict)
    weights: np.ndarray | None = None
    intercept: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = DEFAULT_THRESHOLD


class Scorer:
    """A network made ready: the filters' share in a sum, per word and position, kept for many words."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.known: dict[str, int] = {}
        if net.embedding is not None:
            self.columns = [(w, i) for w in WIDTHS for i in range(w)]
            self.table = np.concatenate([net.embedding @ net.filters[w][i] for w, i in self.columns], axis=1).astype(np.float32)
            self.values = np.zeros((CACHED_WORDS + 1, self.table.shape[1]), dtype=np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Rows of `values` for a block of words; row 0 is the margin."""
        distinct = set(words)
        new = list(distinct.difference(self.known))
        if len(self.known) + len(new) > CACHED_WORDS:
            # Words met first are mostly the frequent ones: half of the room stays theirs, unless a block needs more.
            kept = CACHED_WORDS // 2 if len(distinct) <= CACHED_WORDS // 2 else 0
            self.known = dict(islice(self.known.items(), kept))
            new = list(distinct.difference(self.known))
        if new:
            rows = [word_rows(w) for w in new]
            starts = np.cumsum([0, *map(len, rows)])[:-1]
            first = len(self.known) + 1
            self.values[first : first + len(new)] = np.add.reduceat(self.table[[r for own in rows for r in own]], starts, axis=0)
            self.known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))

    def pooled(self, text: str) -> np.ndarray:
        """Largest rectified value of each filter over a whole text."""
        best = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
        words, edge = words_of(text), max(WIDTHS) - 1
        for at in range(0, max(1, len(words)), BLOCK_WORDS):
            block = words[max(0, at - edge) : at + BLOCK_WORDS]
            # Margins stand at the text's own ends; inner blocks begin with the words before them instead.
            before, after = (np.zeros(edge if end else 0, dtype=np.int64) for end in (at == 0, at + BLOCK_WORDS >= len(words)))
            values = self.values[np.concatenate([before, self._numbers(block), after])]
            for n, width in enumerate(WIDTHS):
                total = np.zeros((len(values) - width + 1, FILTERS), dtype=np.float32)
                for i in range(width):
                    c = self.columns.index((width, i)) * FILTERS
                    total += values[i : i + len(total), c : c + FILTERS]
                part = slice(n * FILTERS, (n + 1) * FILTERS)
                best[part] = np.maximum(best[part], total.max(axis=0) + self.net.bias[width])
        return best

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.net.embedding is None:
            return np.full(len(texts), self.net.prior)
        features = np.array([self.pooled(t) for t in texts]).reshape(len(texts), len(WIDTHS) * FILTERS)
        return 1 / (1 + np.exp(-np.clip(features @ self.net.weights + self.net.intercept, -30, 30)))


@dataclass
class Block:
    """Texts by the numbers of their words, the table rows of these, labels and weights; 0 is the margin beyond either end."""

    rows: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray
    ends: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, texts: Iterable[str], labels: np.ndarray, weights: np.ndarray) -> Block:
        known: dict[str, int] = {}
        numbers = [np.array([known.setdefault(w, len(known) + 1) for w in words_of(t)], dtype=np.int32) for t in texts]
        rows, starts = array("i", [0]), array("i", [0, 1])
        for word in known:
            rows.extend(word_rows(word))
            starts.append(len(rows))
        ends = np.cumsum([0, *map(len, numbers)])[1:]
        return cls(np.array(rows), np.array(starts), np.concatenate([np.zeros(0, dtype=np.int32), *numbers]), ends, labels, weights)

    def __len__(self) -> int:
        return len(self.ends)

    def texts(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of some texts with their margins, one text after the other, and where each begins, the end added."""
        edge = np.zeros(max(WIDTHS) - 1, dtype=np.int32)
        parts = [np.concatenate([edge, self.numbers[self.ends[k - 1] if k else 0 : self.ends[k]], edge]) for k in some]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def rows_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table rows of some words, one after the other, and how many each has."""
        sizes = self.starts[words + 1] - self.starts[words]
        before = np.cumsum(sizes) - sizes
        return self.rows[np.repeat(self.starts[words] - before, sizes) + np.arange(sizes.sum())], sizes


def _largest(shares: list[np.ndarray], at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the largest value of each filter over its positions, and the first place where it stands."""
    more = len(shares) - 1
    best, place = np.full((len(starts) - 1, FILTERS), -np.inf), np.zeros((len(starts) - 1, FILTERS), dtype=np.int64)
    for first in range(0, len(at) - more, BLOCK_WORDS):
        stop = min(first + BLOCK_WORDS, len(at) - more)
        values = sum(share[at[first + i : stop + i]] for i, share in enumerate(shares))
        for k in range(np.searchsorted(starts, first, side="right") - 1, np.searchsorted(starts, stop)):
            low, high = max(starts[k], first), min(starts[k + 1] - more, stop)
            if low < high:
                own = values[low - first : high - first]
                found = own.argmax(axis=0)
                top = own[found, np.arange(FILTERS)]
                place[k] = np.where(top > best[k], found + low, place[k])
                best[k] = np.maximum(best[k], top)
    return best, place


class Learner:
    """A network in training, as one table: the embedding with the sum of each row's squared gradients, then all else."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        self.embedding, self.seen = table[:BUCKETS, :DIMENSION], table[:BUCKETS, DIMENSION]
        self.values, self.squares, at = {}, {}, 0
        rest = table[BUCKETS:].reshape(-1)
        for name, shape in SHAPES.items():
            for into in (self.values, self.squares):
                into[name] = rest[at : at + int(np.prod(shape))].reshape(shape)
                at += into[name].size

    @classmethod
    def new(cls, odds: float, seed: int = SEED) -> Learner:
        """At the start of training, by the odds of a positive row."""
        others = 2 * sum(int(np.prod(shape)) for shape in SHAPES.values())
        made = cls(np.zeros((BUCKETS - (-others // (DIMENSION + 1)), DIMENSION + 1)))
        random = np.random.default_rng(seed)
        made.embedding[:] = random.normal(0, 0.02, (BUCKETS, DIMENSION))
        made.embedding[0] = 0
        for width in WIDTHS:
            made.values[width][:] = random.normal(0, 1 / np.sqrt(DIMENSION * width), (width, DIMENSION, FILTERS))
        made.values["w"][:] = np.where(np.arange(len(WIDTHS) * FILTERS) % 3 == 2, -0.3, 0.3)
        made.values["i"][:] = np.log(odds)
        return made

    def network(self) -> Network:
        filters, bias = ({w: self.values[sign * w] for w in WIDTHS} for sign in (1, -1))
        return Network(embedding=self.embedding, filters=filters, bias=bias, weights=self.values["w"], intercept=float(self.values["i"][0]))

    def vectors(self, block: Block, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The embeddings of words, with the table rows that they are summed from and how many each has."""
        rows, sizes = block.rows_of(words)
        return np.add.reduceat(self.embedding[rows], np.cumsum(sizes) - sizes, axis=0), rows, sizes

    def look(self, block: Block, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Scores of texts, their largest value of each filter and, by width, where these stand."""
        distinct, at = np.unique(words, return_inverse=True)
        vectors = self.vectors(block, distinct)[0]
        pools, places = [], []
        for width in WIDTHS:
            best, place = _largest([vectors @ f for f in self.values[width]], at, starts)
            pools.append(np.maximum(best + self.values[-width], 0))
            places.append(place)
        features = np.concatenate(pools, axis=1)
        return 1 / (1 + np.exp(-np.clip(features @ self.values["w"] + self.values["i"][0], -30, 30))), features, places

    def epoch(self, block: Block, order: np.ndarray) -> None:
        """One pass over a block in steps of `BATCH` texts."""
        columns = [(n, width, i) for n, width in enumerate(WIDTHS) for i in range(width)]
        for first in range(0, len(order), BATCH):
            some = order[first : first + BATCH]
            words, starts = block.texts(some)
            scores, features, places = self.look(block, words, starts)
            delta = block.weights[some] * (scores - block.labels[some])
            back = delta[:, None] * self.values["w"] * (features > 0)
            back = [back[:, n * FILTERS : (n + 1) * FILTERS] for n in range(len(WIDTHS))]
            grads = {"w": delta @ features, "i": delta.sum(keepdims=True), **{-width: back[n].sum(axis=0) for n, width in enumerate(WIDTHS)}}
            chosen = np.stack([words[places[n] + i] for n, _, i in columns])
            vectors, rows, sizes = self.vectors(block, chosen.reshape(-1))
            vectors = vectors.reshape(*chosen.shape, DIMENSION)
            for width in WIDTHS:
                grads[width] = np.stack([np.einsum("kfd,kf->df", vectors[c], back[n]) for c, (n, w, _) in enumerate(columns) if w == width])
            steps = np.stack([self.values[width][i].T * back[n][:, :, None] for n, width, i in columns]).reshape(-1, DIMENSION)
            for name, grad in grads.items():
                self.squares[name] += grad**2
                kept = 0 if name == "i" else 1e-3
                self.values[name] -= RATE * (grad / np.sqrt(self.squares[name] + 1e-6) + kept * self.values[name])
            index, inverse = np.unique(rows, return_inverse=True)
            total = np.zeros((len(index), DIMENSION))
            np.add.at(total, inverse, np.repeat(steps, sizes, axis=0))
            total[index == 0] = 0
            self.seen[index] += (total**2).sum(axis=1)
            self.embedding[index] -= RATE * 2 * total / np.sqrt(self.seen[index] + 1e-4)[:, None]


def fit(texts: list[str], labels: np.ndarray, seed: int = SEED, weights: np.ndarray | None = None) -> Network:
    """Train on whole texts that are at hand, as one block; rows count by their weights, alike without any."""
    positives = int(labels.sum())
    if not positives or positives == len(labels):
        return Network(prior=float(positives / len(labels)) if len(labels) else 0.0)
    weights = np.ones(len(labels)) if weights is None else weights / weights.mean()
    learner = Learner.new((weights * labels).sum() / (weights * (1 - labels)).sum(), seed)
    block, random = Block.of(texts, labels, weights), np.random.default_rng(seed)
    for _epoch in range(EPOCHS):
        learner.epoch(block, random.permutation(len(block)))
    return learner.network()


def best_threshold(values: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The middle of the thresholds in `THRESHOLD_RANGE` whose F1, with rows by their weights, is best."""
    weights = np.ones(len(labels)) if weights is None else weights
    true = weights * (labels == 1)
    f1 = []
    for threshold in THRESHOLDS:
        hit = values >= threshold
        f1.append(2 * true[hit].sum() / max(1e-9, weights[hit].sum() + true.sum()))
    at = np.flatnonzero(np.isclose(f1, max(f1)))
    return float(THRESHOLDS[at[len(at) // 2]])


_ARRAYS = {"rows": np.uint16, "starts": np.int32, "numbers": np.int32, "ends": np.int32, "labels": np.int32}
_BLOCK = ", ".join(["block bigint", *(f"{name} binary" for name in _ARRAYS), "langs array<string>"])
_EMPTY = pa.schema([("block", pa.int64()), *((name, pa.binary()) for name in _ARRAYS), ("langs", pa.list_(pa.string()))])


def _made(rows: pa.Table) -> pa.Table:
    """The texts of a cell that have a label, in a fixed order, as one row of those to learn and one of those to choose thresholds by."""
    let_go()
    narrow = rows.select(["d", "y", "o", "apart"])
    learned = narrow.filter(pc.is_valid(narrow.column("y"))).sort_by([("o", "ascending"), ("d", "ascending"), ("y", "ascending")])
    texts = np.flatnonzero(pc.is_null(narrow.column("y")).to_numpy())
    at = pc.index_in(learned.column("d"), value_set=narrow.column("d").take(pa.array(texts)).combine_chunks())
    learned, at = learned.filter(pc.is_valid(at)), texts[at.drop_null().to_numpy()]
    apart, cell, made = learned.column("apart").to_numpy().astype(bool), rows.column("cell")[0].as_py(), []
    for choosing in (False, True):
        own = learned.filter(pa.array(apart == choosing))
        if not len(own):
            continue
        found = at[apart == choosing].tolist()
        # One text at a time, so that a cell's texts lie in memory once.
        cut = (None if choosing else rows.column("w")[i].as_py() for i in found)
        whole = (rows.column("t")[i].as_py() if w is None else w for i, w in zip(found, cut))
        block = Block.of(whole, own.column("y").to_numpy(), np.zeros(0))
        held = {name: pa.array([getattr(block, name).astype(kind).tobytes()], type=pa.binary()) for name, kind in _ARRAYS.items()}
        langs = pa.array([[rows.column("l")[i].as_py() for i in found]], type=pa.list_(pa.string()))
        made.append(pa.table({"block": pa.array([-1 - cell if choosing else cell], type=pa.int64()), **held, "langs": langs}))
    return pa.concat_tables(made) if made else _EMPTY.empty_table()


def _blocks(batches: Iterator[pa.RecordBatch], weight: dict[int, float]) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for n in range(len(batch)):
            row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
            arrays = {name: np.frombuffer(row[name], dtype=kind).astype(np.int32) for name, kind in _ARRAYS.items()}
            yield row, Block(**arrays, weights=np.array([weight[y] for y in arrays["labels"].tolist()]))


def _epoch(blocks: DataFrame, table: np.ndarray, turn: int, weight: dict[int, float]) -> np.ndarray:
    """The table after one pass over all blocks: the mean of what each made of it, a row over the blocks that moved it."""
    columns = [f"c{i}" for i in range(table.shape[1])]
    shared = blocks.sparkSession.sparkContext.broadcast(table)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for row, block in _blocks(batches, weight):
            learner = Learner(shared.value.copy())
            learner.epoch(block, np.random.default_rng([SEED, turn, row["block"]]).permutation(len(block)))
            moved = np.flatnonzero((learner.table != shared.value).any(axis=1))
            cells = np.rint(learner.table[moved] * SCALE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(moved), *map(pa.array, np.ascontiguousarray(cells.T))], names=["r", *columns])

    made = blocks.mapInArrow(learn, ", ".join(f"{c} bigint" for c in ["r", *columns]))
    mean = made.groupBy("r").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]).toArrow()
    shared.unpersist()
    after = table.copy()
    after[mean.column("r").to_numpy()] = np.stack([mean.column(c).to_numpy() for c in columns], axis=1) / mean.column("n").to_numpy()[:, None] / SCALE
    return after


def _choose(net: Network, blocks: DataFrame, table: np.ndarray, weight: dict[int, float]) -> None:
    """The thresholds by the rows that were not learned."""
    shared = blocks.sparkSession.sparkContext.broadcast(table)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        learner = Learner(shared.value.copy())
        for row, block in _blocks(batches, weight):
            some = [np.arange(first, min(first + BATCH, len(block))) for first in range(0, len(block), BATCH)]
            scores = np.concatenate([learner.look(block, *block.texts(k))[0] for k in some])
            reached = np.searchsorted(THRESHOLDS, scores, side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(row["langs"], type=pa.string()), pa.array(block.labels), pa.array(reached)], names=["l", "y", "r"])

    rows = blocks.mapInArrow(judge, "l string, y int, r bigint").groupBy("l", "y", "r").agg(F.count("*").alias("n")).orderBy("l", "y", "r").collect()
    shared.unpersist()
    values = np.array([0.0, *THRESHOLDS])[[r["r"] for r in rows]]
    truth, many = (np.array([r[c] for r in rows]) for c in ("y", "n"))
    weights = many * np.array([weight[y] for y in truth.tolist()])
    if truth.any():
        net.threshold = best_threshold(values, truth, weights)
    for language in sorted({r["l"] for r in rows if r["l"] is not None}):
        own = np.array([r["l"] == language for r in rows])
        if (many * truth)[own].sum() >= LEAST_POSITIVES:
            net.thresholds[language] = best_threshold(values[own], truth[own], weights[own])


def train(labelled: DataFrame, label: str = "toxic", texts: DataFrame | None = None) -> Network:
    """A network and its thresholds from all labelled rows.

    `labelled` has doc_id, text, lang and the label. Where it is a join, `texts` with the same doc_id, text
    and lang is the table to read the texts from, so that the join itself stays narrow.
    """
    bounded_batches(labelled.sparkSession)
    id_ = F.col("doc_id").alias("d")
    given = labelled.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    order = sample_order(F.col("d"))
    keys = written(given.select(id_, F.col(label).cast("int").alias("y")).distinct().withColumns({"o": order, "cell": F.shiftright(order, ORDER_SHIFT)}), "keys")
    source = (given if texts is None else texts).select(id_, whole_text().alias("t"), F.col("lang").cast("string").alias("l"))
    sizes = {r["y"]: r["n"] for r in keys.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Network(prior=float(max(sizes, default=0)))
    # The rows of a class are numbered in cells of their order, so that no task gets a whole class.
    earlier = Window.partitionBy("y").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keys.groupBy("y", "cell").agg(F.count("*").alias("_n")).withColumn("_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    place = F.col("_n") + F.row_number().over(Window.partitionBy("y", "cell").orderBy("o", "d"))
    keys = keys.join(F.broadcast(cells), ["y", "cell"]).withColumn("place", place)
    keys = keys if SAMPLE_PER_CLASS is None else keys.where(F.col("place") <= SAMPLE_PER_CLASS)
    keys = written(keys.select("d", "y", "o", (F.col("place") % CALIBRATION_SHARE == 0).alias("apart")), "numbered")
    lengths = source.groupBy("d").agg(F.max(F.length("t")).alias("n"))
    sums = keys.join(lengths, "d").groupBy("apart", "y").agg(F.count("*").alias("n"), F.sum("n").alias("chars")).collect()
    taken = {y: sum(r["n"] for r in sums if r["y"] == y) for y in sizes}
    scale = sum(taken.values()) / sum(sizes.values())
    weight = {y: scale * n / max(taken[y], 1) for y, n in sizes.items()}
    many = 1 + sum(r["chars"] for r in sums if not r["apart"]) // BLOCK_CHARS
    # Keys and texts meet in one shuffle, by block: few texts but those of labelled rows, and each of them once.
    cell, none = F.pmod(F.xxhash64(F.lit("block"), "d"), F.lit(many)).alias("cell"), F.lit(None)
    cut = none.cast("string") if SAMPLE_CHARS is None else windows(F.col("t"), F.col("d"), SAMPLE_CHARS)
    found = likely(source, keys.select("d"), "d", sum(taken.values())).select(cell, "d", "t", "l", cut.alias("w"))
    rows = keys.select(cell, "d", "y", "o", "apart").unionByName(found, allowMissingColumns=True).repartition(many, "cell")
    rows = rows.groupBy("cell", "d", "y", "o", "apart").agg(F.min(F.struct("t", "l", "w")).alias("_")).select("cell", "d", "y", "o", "apart", "_.*")
    blocks = written(rows.groupBy("cell").applyInArrow(_made, _BLOCK), "blocks")
    learner = Learner.new(sum(weight[y] * n * y for y, n in taken.items()) / sum(weight[y] * n * (1 - y) for y, n in taken.items()))
    # More blocks make more steps of a pass.
    for turn in range(max(LEAST_EPOCHS, -(-EPOCHS // many))):
        learner = Learner(_epoch(blocks.where("block >= 0"), learner.table, turn, weight))
    net = learner.network()
    _choose(net, blocks.where("block < 0"), learner.table, weight)
    return net


def score(docs: DataFrame, net: Network, text: str = "text", output: str = "score") -> DataFrame:
    """`docs` with the score of each whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(net)
    key = uuid.uuid4().hex

    @F.arrow_udf("double")
    def value(column: pa.Array) -> pa.Array:
        ready = worker_cache("toxicity", dict)
        if ready.get("key") != key:
            ready.update(key=key, scorer=Scorer(shared.value))
        return pa.array(ready["scorer"].scores([t or "" for t in column.to_pylist()]), type=pa.float64())

    return docs.withColumn(output, value(whole_text(text)))


def threshold_of(net: Network, lang: Column) -> Column:
    """The threshold of a language, else the overall one."""
    found = F.lit(net.threshold)
    for language, threshold in net.thresholds.items():
        found = F.when(lang == language, F.lit(threshold)).otherwise(found)
    return found


def flag(docs: DataFrame, net: Network, text: str = "text", lang: str = "lang") -> DataFrame:
    """`docs` with `score`, the `threshold` that holds for its language, and `flagged`."""
    found = score(docs, net, text).withColumn("threshold", threshold_of(net, F.col(lang)))
    return found.withColumn("flagged", F.col("score") >= F.col("threshold"))
