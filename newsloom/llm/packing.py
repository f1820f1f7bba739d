"""Best-fit packing of documents into sequences by bin completion over lengths.

Pieces of one length are interchangeable, so the plan is made for the histogram of lengths: at most
`capacity` rows, whatever the number of documents. Best-fit decreasing over the histogram gives the
first incumbent. Where it misses the lower bound, branch and bound takes over: around the largest
length left it enumerates fillings, drops the dominated ones (an unused length could replace some
of the chosen ones and waste less), applies one as often as the lengths allow, and prunes when the
waste so far rules out a better plan than the incumbent. Each pass looks at a few fillings of a node;
a pass that ends without meeting the bound is followed by one with four times as many, until a pass has
left none out or `effort` steps are used, which bounds the search and never the pieces: every plan places
all of them. `search` reports bound, steps and whether the plan is proven best.

The pieces are put into one total order by a range shuffle of narrow rows, and a piece's number in
that order says which sequence and offset of the plan are its own. A length that a third of all
pieces have is spread over many ranges.

A NULL text counts as empty and gives one piece with the end id alone. Repeated rows are packed each
on its own. Other columns of the input are not carried. Without documents there are no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, whole_text
from newsloom.llm.tokens import END_ID, default_vocabulary, document_ids
from newsloom.session import stage

CAPACITY = 4096
EFFORT = 200_000
#: Fillings of a node and steps to find them in the first pass.
FILLINGS = 4
TRIES = 400

# A plan is a list of (lengths of one sequence in falling order, number of such sequences).
Plan = list[tuple[tuple[int, ...], int]]


def best_fit(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, all sequences of one content at a time."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(content: tuple[int, ...], times: int) -> None:
        room = capacity - sum(content)
        if room not in open_by_room:
            open_by_room[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_by_room[room].append((content, times))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if left // fit:
                    put((length,) * fit, left // fit)
                if left % fit:
                    put((length,) * (left % fit), 1)
                break
            room = rooms[at]
            content, times = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room], rooms[at]
            fit = room // length
            full = min(times, left // fit)
            if full:
                put(content + (length,) * fit, full)
                left -= full * fit
            if full < times:
                if left:
                    put(content + (length,) * left, 1)
                if times - full - bool(left):
                    put(content, times - full - bool(left))
                left = 0
    return [entry for room in rooms for entry in open_by_room[room]]


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Sequences that any plan needs.

    The sum of all lengths must fit. Of pieces at least `k` long no more than `capacity // k` lie together.
    Pieces over half the capacity lie apart from each other; of those at least `k` long, the smaller ones only
    fit beside pieces of at most `capacity - k`. The best `k` counts.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    counts[list(histogram)] = list(histogram.values())
    size = np.arange(capacity + 1)
    half = capacity // 2
    large = int(counts[half + 1 :].sum())
    # From the top down: what pieces of at least k weigh, those up to half only; what room pieces over half and up to a length leave.
    small = np.cumsum((counts * size)[half::-1])[::-1]
    room = np.cumsum((counts * (capacity - size))[half + 1 :])
    k = np.arange(half + 1)
    beside = room[capacity - k - half - 1] if len(room) else np.zeros(half + 1, dtype=np.int64)
    beside = np.where(capacity - k > half, beside, 0)
    apart = large + np.maximum(0, -((beside - small) // capacity))
    together = -(-np.cumsum(counts[:0:-1])[::-1] // (capacity // size[1:]))
    return max(-(-int((counts * size).sum()) // capacity), int(apart.max()), int(together.max()))


def _dominated(filling: list[int], waste: int, lengths: list[int], counts: Counter) -> bool:
    """Whether an unused length could replace some of the filling and leave less waste."""
    if not waste:
        return False
    sums = 1  # bit s: some of the filling have the sum s
    for length in filling:
        sums |= sums << length
    used, below = Counter(filling), (1 << waste) - 1
    return any(counts[length] > used[length] and (sums >> max(0, length - waste)) & (below >> max(0, waste - length)) for length in lengths)


def fillings(counts: Counter, lengths: list[int], room: int, most: int, tries: int) -> tuple[list[list[int]], bool, int]:
    """Undominated fillings, least waste first, whether `most` or `tries` left any out, and the steps taken.

    A step takes some pieces of one length; a test for dominance counts as many by the lengths it looks at.
    """
    found: list[tuple[int, list[int]]] = []
    steps, full, cut = 0, 0, False

    def grow(room: int, below: int, chosen: list[tuple[int, int]]) -> None:
        nonlocal steps, full, cut
        grown = False
        for at in range(bisect_right(lengths, min(room, below)) - 1, -1, -1):
            length = lengths[at]
            for copies in range(min(room // length, counts[length]), 0, -1):
                if steps >= tries or full >= most:
                    cut = True
                    return
                steps += 1
                grown = True
                grow(room - copies * length, length - 1, [*chosen, (length, copies)])
        used = dict(chosen)
        if grown or any(counts[length] > used.get(length, 0) for length in lengths[: bisect_right(lengths, room)]):
            return
        filling = [length for length, copies in chosen for _ in range(copies)]
        if found and room:
            steps += len(lengths) // 16 + len(filling)
            if _dominated(filling, room, lengths, counts):
                return
        found.append((room, filling))
        full += not room

    grow(room, room, [])
    found.sort(key=lambda f: f[0])
    return [filling for _, filling in found[:most]], cut or len(found) > most, steps + 1


@dataclass
class Outcome:
    """A plan, its number of sequences, the bound below which there is none, the steps used, and whether the plan is the best."""

    plan: Plan
    size: int
    bound: int
    steps: int
    proven: bool


def _pass(found: Outcome, histogram: dict[int, int], capacity: int, effort: int, most: int, tries: int) -> bool:
    """One branch and bound, which improves `found`; whether it ended with nothing left out.

    A filling is applied as often as the lengths allow. Plans that use it a smaller number of times are
    left out by that, so only a pass over lengths that allow it once proves anything.
    """
    total = sum(length * n for length, n in histogram.items())
    counts, lengths = Counter(histogram), sorted(histogram)
    # One entry per decision: the content, its copies, the lengths that ran out, the other fillings, the waste before.
    path: list[tuple[tuple[int, ...], int, list[int], list[list[int]], int]] = []
    waste, options, whole = 0, None, True
    while found.size > found.bound and found.steps < effort:
        allowed = (found.size - 1) * capacity - total
        if options is None:
            if not lengths:
                found.plan, found.size, options = [(c, t) for c, t, *_ in path], sum(t for _, t, *_ in path), []
                continue
            largest = lengths[-1]
            counts[largest] -= 1
            rest, cut, steps = fillings(counts, lengths, capacity - largest, most, min(tries, effort - found.steps))
            options, whole = [[largest, *chosen] for chosen in rest], whole and not cut
            counts[largest] += 1
            found.steps += steps
        step = None
        while options and step is None:
            content = tuple(options.pop(0))
            copies = Counter(content)
            times = min(counts[length] // n for length, n in copies.items())
            if waste + times * (capacity - sum(content)) <= allowed:
                step = (content, times, copies)
            elif times > 1:
                whole = False
        if step is not None:
            content, times, copies = step
            whole = whole and times == 1
            gone = []
            for length, n in copies.items():
                counts[length] -= n * times
                if not counts[length]:
                    gone.append(length)
                    lengths.pop(bisect_left(lengths, length))
            path.append((content, times, gone, options, waste))
            waste += times * (capacity - sum(content))
            options = None
        elif path:
            content, times, gone, options, waste = path.pop()
            for length in gone:
                lengths.insert(bisect_left(lengths, length), length)
            for length in content:
                counts[length] += times
        else:
            return whole
    return False


def search(histogram: dict[int, int], capacity: int, effort: int = EFFORT) -> Outcome:
    """The plan with the fewest sequences that the search finds."""
    best = best_fit(histogram, capacity)
    size = sum(times for _, times in best)
    found = Outcome(best, size, lower_bound(histogram, capacity), 0, False)
    most, tries, ended = FILLINGS, TRIES, False
    while found.size > found.bound and found.steps < effort and not ended:
        ended = _pass(found, histogram, capacity, effort, most, tries)
        if most > 1 << 20:
            break
        most, tries = 4 * most, 4 * tries
    found.proven = ended or found.size == found.bound
    return found


def complete(histogram: dict[int, int], capacity: int, effort: int = EFFORT) -> Plan:
    return search(histogram, capacity, effort).plan


def segments(plan: Plan) -> dict[str, np.ndarray]:
    """The plan by position: pieces in rising order of length, numbered from 0, are dealt out in runs.

    A run starts at position `start`; its pieces of length `length` go `copies` to a sequence,
    beginning with sequence `sequence`, from `offset` on.
    """
    runs, sequence = [], 0
    for content, times in plan:
        offset = 0
        for length, copies in sorted(Counter(content).items()):
            runs.append((length, copies * times, copies, sequence, offset))
            offset += length * copies
        sequence += times
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    return {
        "start": np.cumsum(table[:, 1]) - table[:, 1],
        "length": table[:, 0],
        "copies": table[:, 2],
        "sequence": table[:, 3],
        "offset": table[:, 4],
    }


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    bounded_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    @F.arrow_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def cut(column: pa.Array) -> pa.Array:
        rows = []
        for value in column:
            ids = document_ids(value.as_py() or "", path, end_id)
            step = 4 * capacity
            rows.append(
                [
                    {"piece": n, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                    for n, at in enumerate(range(0, len(ids), step))
                    for part in [ids[at : at + step]]
                ]
            )
        return pa.array(rows, type=kind)

    return docs.select("doc_id", F.explode(cut(whole_text())).alias("p")).select("doc_id", "p.*")


def numbered(rows: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Staged rows with `_row` (partition and row in it), and the rows before each partition."""
    staged = rows.withColumn("_row", F.monotonically_increasing_id())
    sizes = {r["p"]: r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    before = np.zeros(max(sizes, default=-1) + 1, dtype=np.int64)
    for part in range(1, len(before)):
        before[part] = before[part - 1] + sizes.get(part - 1, 0)
    return staged, before


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID, effort: int = EFFORT) -> DataFrame:
    """Every piece with `sequence_id` and `offset`: in a sequence its pieces lie without gaps from 0."""
    cut = stage(pieces(docs, capacity, vocabulary, end_id))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(segments(complete(histogram, capacity, effort)))
    order = ["length", "doc_id", "piece", "ids_crc32"]
    staged, before = numbered(stage(cut.repartitionByRange(*order).sortWithinPartitions(*order)))
    starts = docs.sparkSession.sparkContext.broadcast(before)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(column: pa.Array) -> pa.Array:
        rows = column.to_numpy(zero_copy_only=False).astype(np.int64)
        position = starts.value[rows >> 33] + (rows & ((1 << 33) - 1))
        runs = plan.value
        run = np.searchsorted(runs["start"], position, side="right") - 1
        nth = position - runs["start"][run]
        copies = runs["copies"][run]
        sequence = runs["sequence"][run] + nth // copies
        offset = runs["offset"][run] + nth % copies * runs["length"][run]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    return staged.withColumn("_place", place(F.col("_row"))).select("doc_id", "piece", "start", "length", "ids_crc32", "_place.*")
