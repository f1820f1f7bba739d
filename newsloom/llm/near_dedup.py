"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

A text's set is that of its distinct word shingles (64-bit hashes of `width` words, A to Z in lower
case); a text with fewer words has its whole sequence as one shingle, one without words has none and
is linked with nothing. Equal sets are one class, represented by its smallest id.

SuperMinHash gives each shingle one uniform draw per rank and a permutation of the ranks over the
slots, so that a slot keeps rank + draw of the best shingle; ranks are worked off for all shingles of
a text at once and end as soon as no slot can improve. The permutations are keyed bijections of the
slots. Signatures of 256 slots are cut into 42 bands of 6: two sets with similarity 0.8 share no
band with a probability below 3e-6.

Within a band's bucket no pairs are spelt out. First each member is verified against the bucket's
smallest id only; union-find over these links settles every bucket whose members all meet in one
component. In the others, the members outside the bucket's largest component are verified against the
smallest id among them, and components are made again. What then lies outside a bucket's largest
component is compared by signature with all its members, in cells of bounded size and only across
components; members of that component are never dealt against each other, so a bucket of a million
near copies and a few outsiders costs a copy of each row for each cell of outsiders. Members whose
signatures agree in at least `SIGNATURE_SHARE` of the slots (about five standard deviations below the
threshold) are verified too. Verification is exact: it compares the full sets made from both whole texts.

`doc_id` is the key: rows that repeat an id are one document, which has every set that its rows have
and is linked by any of them; `n_shingles` is each row's own. Rows with a NULL id are in no group:
their component is NULL and they are kept. Texts of any length count whole, an empty table gives no
rows. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, fresh, whole_text, worker_cache, written
from newsloom.llm.components import components

WIDTH = 4
PERCENT = 80
SLOTS = 256
ROWS = 6
BANDS = 42
SIGNATURE_SHARE = 0.68
CELL = 2000
CELL_SHINGLES = 1_000_000
FIRST_SLOTS, FIRST_SHARE = 64, 0.55
TOGETHER = 10_000
PIVOT_PAIRS = 5_000
CACHED_WORDS = 100_000

_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = worker_cache("shingle words", dict)
    new = set(words).difference(known)
    if len(known) + len(new) > CACHED_WORDS:
        known.clear()
        new = set(words)
    for word in new:
        known[word] = xxhash.xxh64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(width, len(words))
    made = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        made = mix(made + _M3) ^ hashes[i : i + len(made)]
    return np.unique(mix(made + _M3))


def set_id(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def super_minhash(sets: list[np.ndarray]) -> np.ndarray:
    """The signatures of non-empty sets: per slot the least rank + draw of a set's elements.

    All sets are worked on at once; one whose slots cannot improve any more leaves.
    """
    slots = np.full((len(sets), SLOTS), np.inf)
    elements = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys = mix(elements + _M3)
    a, b, c, d = ((keys >> np.uint64(s)).astype(np.int64) & (SLOTS - 1) for s in (0, 8, 16, 24))
    a, c = a | 1, c | 1
    for rank in range(SLOTS):
        draw = (mix(elements + np.uint64(rank + 2) * _M3) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        place = (a * rank + b) & (SLOTS - 1)
        place = (c * (place ^ (place >> 4)) + d) & (SLOTS - 1)
        place ^= place >> 3
        np.minimum.at(slots.reshape(-1), row * SLOTS + place, draw + rank)
        open_rows = slots.max(axis=1) > rank + 1
        if not open_rows.any():
            break
        stay = open_rows[row]
        if not stay.all():
            elements, row, a, b, c, d = (x[stay] for x in (elements, row, a, b, c, d))
    return slots


def _bands(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * ROWS].view(np.uint64).reshape(BANDS, ROWS)
    made = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        made = mix(made + _M3) ^ rows[:, i]
    return mix(made).view(np.int64)


_SIGNED = "struct<n_shingles:bigint,set_id:binary,bands:array<bigint>,signature:binary>"


def signed(text: Column, width: int) -> Column:
    """Set size, 128-bit id of the set, band hashes and the signature in 16 bits per slot."""

    @F.arrow_udf(_SIGNED)
    def sign(column: pa.Array) -> pa.Array:
        sizes, ids, bands, signatures = [], [], [], []
        waiting: list[np.ndarray] = []

        def sign_waiting() -> None:
            for signature in super_minhash(waiting) if waiting else ():
                bands.append(_bands(signature))
                signatures.append((mix(signature.view(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes())
            waiting.clear()

        with np.errstate(over="ignore"):
            held = 0
            for value in column:
                elements = shingle_set(value.as_py() or "", width)
                sizes.append(len(elements))
                if len(elements):
                    ids.append(set_id(elements))
                    waiting.append(elements)
                    held += len(elements)
                else:
                    sign_waiting()
                    ids.append(None), bands.append(None), signatures.append(None)
                if held >= TOGETHER:
                    sign_waiting()
                    held = 0
            sign_waiting()
        arrays = [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
        return pa.StructArray.from_arrays(arrays, names=["n_shingles", "set_id", "bands", "signature"])

    return sign(text)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity; `texts` has doc_id and text."""

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        found, last, ours = [], None, None
        with np.errstate(over="ignore"):
            for a, b in zip(left, right):
                a = a.as_py()
                if a != last:
                    last, ours = a, shingle_set(a, width)
                theirs = shingle_set(b.as_py(), width)
                common = len(np.intersect1d(ours, theirs, assume_unique=True))
                found.append(100 * common >= percent * (len(ours) + len(theirs) - common))
        return pa.array(found, pa.bool_())

    ids = written(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "candidate-ids")
    used = written(texts.join(ids, "doc_id", "left_semi"), "candidate-texts")
    members = pairs.join(used.select(F.col("doc_id").alias("v"), F.col("text").alias("right")), "v")
    # A pivot with many pairs is dealt to several tasks, each with its text.
    hot = written(pairs.groupBy("u").agg(F.ceil(F.count("*") / PIVOT_PAIRS).cast("int").alias("_salts")).where("_salts > 1"), "hot-pivots")
    salted = members.join(hot, "u", "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("v"), F.col("_salts")).cast("int"), F.lit(0)))
    pivots = used.select(F.col("doc_id").alias("u"), F.col("text").alias("left")).join(hot, "u", "left")
    pivots = pivots.select("u", "left", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt"))
    both = salted.join(pivots, ["u", "_salt"])
    return both.where(linked(F.col("left"), F.col("right"))).select("u", "v").distinct()


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _sorted_cell(cell: pa.Table) -> pa.Table:
    """The cell by set size, one row per set of a member."""
    sizes, reps, which = (cell.column(c).to_numpy() for c in ("n_shingles", "rep", "which"))
    order = np.lexsort((which, reps, sizes))
    again = (np.diff(reps[order]) == 0) & (np.diff(which[order]) == 0)
    keep = np.ones(len(cell), dtype=bool)
    keep[1:] = ~again
    return cell.take(order[keep])


def _close_pairs(cell: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of a cell with the later rows close to them, across components and, in a cell of two blocks, across these.

    A row of the bucket's largest component is left alone with its like, as all of one component are.

    The cell is sorted by set size. A first look at some slots, five standard deviations below the
    threshold, leaves few rows for the whole signature. A pair that already met in the bucket of an
    earlier band is left to that one.
    """
    marks = np.frombuffer(b"".join(cell.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SLOTS)
    first = marks[:, :FIRST_SLOTS].astype(np.uint8)
    bands = cell.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    earlier = bands[:, : cell.column("nth")[0].as_py()]
    sizes, parts, blocks = (cell.column(c).to_numpy() for c in ("n_shingles", "component", "block"))
    stops = np.searchsorted(sizes, sizes * (100 / percent) + 1e-9, side="right")
    single = blocks.min() == blocks.max()
    least = FIRST_SHARE * FIRST_SLOTS
    for i in range(len(cell) - 1):
        later = slice(i + 1, stops[i])
        alike = np.count_nonzero(first[later] == first[i], axis=1) >= least
        alike &= parts[later] != parts[i]
        if not single:
            alike &= blocks[later] != blocks[i]
        near = np.flatnonzero(alike) + i + 1
        if len(near):
            near = near[np.count_nonzero(marks[near] == marks[i], axis=1) >= SIGNATURE_SHARE * SLOTS]
            near = near[~(earlier[near] == earlier[i]).any(axis=1)]
        if len(near):
            yield i, near


_CELL = "band bigint, nth int, i int, j int, rep bigint, which int, n_shingles bigint, component bigint, block int, set_id binary, bands array<bigint>, signature binary"


def _open_buckets(members: DataFrame) -> DataFrame:
    """Buckets whose members lie in several components, with the component that most of them are in."""
    counted = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    return counted.groupBy("band").agg(F.max(F.struct("n", "component"))["component"].alias("_main"), F.count("*").alias("_parts")).where("_parts > 1").select("band", "_main")


def _dealt(members: DataFrame) -> DataFrame:
    """Members of open buckets by cell (band, i, j).

    Blocks of about `CELL` rows or `CELL_SHINGLES` shingles: negative ones of the largest component, others
    from 0. Two blocks meet in a cell unless both are of the largest component.
    """
    opened = members.join(written(_open_buckets(members), "open"), "band").withColumn("_apart", F.col("component") != F.col("_main"))

    def blocks(apart: Column) -> Column:
        return F.greatest(F.ceil(F.count_if(apart) / CELL), F.ceil(F.sum(F.when(apart, F.col("n_shingles")).otherwise(0)) / CELL_SHINGLES)).cast("int")

    sizes = written(opened.groupBy("band").agg(blocks(F.col("_apart")).alias("_others"), blocks(~F.col("_apart")).alias("_mains")), "blocks")
    wide = opened.join(sizes, "band")
    block = F.when(F.col("_apart"), F.pmod(F.xxhash64("rep"), F.col("_others"))).otherwise(-1 - F.pmod(F.xxhash64("rep"), F.col("_mains"))).cast("int")
    meets = F.when(F.col("_apart"), F.sequence(-F.col("_mains"), F.col("_others") - 1)).otherwise(F.sequence(F.lit(0), F.col("_others") - 1))
    cells = wide.withColumn("block", block).withColumn("_other", F.explode(meets))
    return cells.withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")})


def _across(members: DataFrame, signatures: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between the components that meet in a bucket.

    Members whose signature is close to that of another component get their texts, one row per member and
    cell, and the cell verifies its close pairs on the full sets. What it has linked counts as one component
    from there on, so no row is made per pair.
    """
    cells = _dealt(members)
    names = [c.split()[0] for c in _CELL.split(", ")]

    def screen(cell: pa.Table) -> pa.Table:
        cell = _sorted_cell(cell)
        close = np.zeros(len(cell), dtype=bool)
        for i, near in _close_pairs(cell, percent):
            close[i] = True
            close[near] = True
        return cell.filter(pa.array(close)).select(names)

    def settle(cell: pa.Table) -> pa.Table:
        # A member whose rows differ comes with each of its texts; those of the set are taken.
        with np.errstate(over="ignore"):
            own = [set_id(shingle_set(t, width)) == s for t, s in zip(cell.column("text").to_pylist(), cell.column("set_id").to_pylist())]
        cell = _sorted_cell(cell.filter(pa.array(own, type=pa.bool_())))
        reps, parts = (cell.column(c).to_pylist() for c in ("rep", "component"))
        parent = {p: p for p in parts}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        left, right = [], []
        with np.errstate(over="ignore"):
            sets = [shingle_set(t, width) for t in cell.column("text").to_pylist()]
            for i, near in _close_pairs(cell, percent):
                for k in near:
                    a, b = root(parts[i]), root(parts[k])
                    if a == b:
                        continue
                    common = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
                    if 100 * common >= percent * (len(sets[i]) + len(sets[k]) - common):
                        parent[max(a, b)] = min(a, b)
                        left.append(reps[i])
                        right.append(reps[k])
        return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})

    screened = cells.join(signatures, ["rep", "which"]).select(*names).groupBy("band", "i", "j").applyInArrow(screen, _CELL)
    close = written(screened, "close")
    ids = written(close.select("rep").distinct(), "close-ids")
    used = texts.join(ids, texts["doc_id"] == ids["rep"], "left_semi").select(F.col("doc_id").alias("rep"), "text")
    return close.join(used, "rep").groupBy("band", "i", "j").applyInArrow(settle, "u bigint, v bigint").distinct()


def _star_links(stars: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links between members of buckets and their bucket's pivot `p`."""
    near = stars.where((F.col("rep") != F.col("p.rep")) & _near_in_size(F.col("n_shingles"), F.col("p.n_shingles"), percent))
    pairs = written(near.select(F.col("p.rep").alias("u"), F.col("rep").alias("v")).distinct(), "stars")
    return written(verified(pairs, texts, width, percent), "links")


def _with_components(shared: DataFrame, settled: DataFrame) -> DataFrame:
    of = shared.join(settled.withColumnRenamed("node", "rep"), "rep", "left")
    return of.withColumn("component", F.coalesce("component", "rep"))


def groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id"), whole_text().alias("text"))
    sets = written(texts.select("doc_id", signed(F.col("text"), width).alias("s")).select("doc_id", "s.*"), "signatures")
    usable = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    of_rep = Window.partitionBy("rep").orderBy("set_id")
    classes = written(usable.groupBy("set_id").agg(F.min("doc_id").alias("rep")).withColumn("which", F.row_number().over(of_rep)), "classes")
    # On the id as well: a class of a third of all rows would meet in one task by its set alone.
    first = usable.join(classes.withColumnRenamed("rep", "doc_id"), ["set_id", "doc_id"])
    reps = first.select(F.col("doc_id").alias("rep"), "which", "set_id", "n_shingles", "bands", "signature")
    banded = written(reps.select("rep", "which", "n_shingles", F.posexplode("bands").alias("nth", "band")).distinct(), "bands")
    pivots = banded.groupBy("band").agg(F.min(F.struct("rep", "n_shingles")).alias("p"), F.count("*").alias("n")).where("n > 1").select("band", "p")
    shared = written(banded.join(pivots, "band"), "buckets")
    links = _star_links(shared, texts, width, percent)
    members = _with_components(shared.drop("p"), components(links))
    apart = members.join(written(_open_buckets(members), "open"), "band").where(F.col("component") != F.col("_main"))
    second = apart.groupBy("band").agg(F.min(F.struct("rep", "n_shingles", "component")).alias("p"))
    across = apart.join(second, "band").where(F.col("component") != F.col("p.component"))
    links = written(links.unionByName(_star_links(across, texts, width, percent)), "links")
    members = written(_with_components(shared.drop("p"), components(links)), "members")
    more = _across(members, reps.select("rep", "which", "set_id", "bands", "signature").dropDuplicates(["rep", "which"]), texts, width, percent)
    final = components(links.unionByName(more))
    grouped = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component_id"))
    # Rows without a set, all empty texts among them, meet nothing and stay out of the join.
    rows = sets.select("doc_id", "n_shingles", "set_id")
    none = rows.where(F.col("set_id").isNull()).select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    found = rows.where(F.col("set_id").isNotNull()).join(grouped, "set_id", "left").select("doc_id", "n_shingles", "component_id").unionByName(none)
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """`docs` with one document of each group: that with the smallest id, and of its repeated rows the first by text.

    Rows with a NULL id stay.
    """
    found = groups(docs, width, percent).where(F.col("kept") & F.col("doc_id").isNotNull())
    keep = written(found.select(F.col("doc_id").alias("_keep")).distinct(), "kept")
    nth = fresh(docs.columns, "_nth")
    sortable = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and kind != "variant"]
    order = Window.partitionBy("doc_id").orderBy("text", *sortable)
    one = docs.join(keep, docs["doc_id"] == keep["_keep"], "left_semi").withColumn(nth, F.row_number().over(order))
    return one.where(F.col(nth) == 1).drop(nth).unionByName(docs.where(F.col("doc_id").isNull()))
