"""Training-order materialisation: token ids in fixed-stride binary shards, in a keyed random order.

The documents' ids, each with its end id, form one stream in the order of a staged table; the stream
is cut into sequences of `length` ids, and only the last one is padded. A keyed Feistel permutation
with cycle-walking gives each of the N sequences its own slot in [0, N): no shuffle key, no collision,
and the inverse is as cheap. Shard k holds the slots from k * `slots` on, each at the same stride, so
training reads the files front to back and resumes at any slot by one seek.

Every shard is one partition (`repartitionById`), sorted by slot and written as it streams by. It is
written under a task's own name and then renamed, so a repeated or speculative task changes nothing.
The result tells for each part of a document where its ids are.

NULL texts count as empty: they are their end id alone. A very long text is encoded whole and its ids
lie in as many sequences as they need. Repeated rows are kept. Other columns are not carried. Without
documents there are no shards.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, whole_text
from newsloom.llm.tokens import END_ID, default_vocabulary, document_ids
from newsloom.session import shared_dir, stage

LENGTH = 2048
SLOTS = 4096
PAD_ID = 0
ID_TYPE = "<u2"
ROUNDS = 4


def _round(half: np.ndarray, key: int, mask: int) -> np.ndarray:
    """A keyed mixing of half words (the finaliser of splitmix64)."""
    x = half.astype(np.uint64) + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(mask)


def _keys(key: int) -> list[int]:
    return [int(k) for k in np.random.SeedSequence(key).generate_state(ROUNDS, np.uint64)]


def permute(numbers: np.ndarray, size: int, key: int, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of [0, size), or its inverse, by element.

    The Feistel network permutes the next power of four; where it leaves the range it is applied
    again, which ends in the range as the cycle began there.
    """
    bits = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, shift = (1 << bits) - 1, np.uint64(bits)
    keys = _keys(key)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & np.uint64(mask)
        for k in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _round(left, k, mask), left
            else:
                left, right = right, left ^ _round(right, k, mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = network(np.asarray(numbers).astype(np.uint64))
        while (far := out >= size).any():
            out[far] = network(out[far])
    return out.astype(np.int64)


def _stream(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Staged documents with their packed ids and numbers of ids."""

    @F.arrow_udf("struct<n:bigint,ids:binary>")
    def encode(column: pa.Array) -> pa.Array:
        coder = zstandard.ZstdCompressor(level=1)
        counts, packed = [], []
        for value in column:
            ids = np.frombuffer(document_ids(value.as_py() or "", vocabulary, end_id), dtype="<u4")
            counts.append(len(ids))
            packed.append(coder.compress(ids.astype(ID_TYPE).tobytes()))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(packed, pa.binary())], names=["n", "ids"])

    return stage(docs.select("doc_id", encode(whole_text()).alias("e")).select("doc_id", "e.*"))


_PARTS = "doc_id bigint, start bigint, slot bigint, at int, length int, ids binary"


def write_shards(
    docs: DataFrame,
    root: str,
    key: int,
    length: int = LENGTH,
    slots: int = SLOTS,
    vocabulary: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Write the shards under `root` and return where each part of each document lies.

    The rows are made by the writing tasks: the shards exist once the result has been computed.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    staged = _stream(docs, vocabulary or default_vocabulary(), end_id).withColumn("p", F.spark_partition_id())
    totals = {r["p"]: r["n"] for r in staged.groupBy("p").agg(F.sum("n").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(totals):
        before[part], total = total, total + totals[part]
    sequences = -(-total // length)
    shards = max(1, -(-sequences // slots))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, plain = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        at = None
        for batch in batches:
            rows = []
            for doc_id, packed, part in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "p"))):
                at = before[part] if at is None else at
                ids = np.frombuffer(plain.decompress(packed), dtype=ID_TYPE)
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(at, length)
                    n = min(length - offset, len(ids) - start)
                    rows.append((doc_id, start, sequence, offset, n, coder.compress(ids[start : start + n].tobytes())))
                    start, at = start + n, at + n
            if rows:
                doc_ids, starts, numbers, offsets, counts, parts = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(permute(np.array(numbers, dtype=np.int64), sequences, key)),
                        pa.array(offsets, pa.int32()),
                        pa.array(counts, pa.int32()),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "start", "slot", "at", "length", "ids"],
                )

    stride = length * np.dtype(ID_TYPE).itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        shard, out, names, buffer, current = None, None, None, None, None
        store, folder = _store(root)

        def close() -> None:
            if out is not None:
                out.write(buffer)
                out.close()
                store.move(*names)

        for batch in batches:
            slot_of = batch.column("slot").to_pylist()
            for slot, at, packed in zip(slot_of, batch.column("at").to_pylist(), batch.column("ids").to_pylist()):
                if slot != current:
                    if slot // slots != shard:
                        close()
                        shard = slot // slots
                        final = shard_path(folder, shard)
                        names = (f"{final}.{uuid.uuid4().hex}", final)
                        out = store.open_output_stream(names[0])
                    else:
                        out.write(buffer)
                    buffer, current = bytearray(np.full(length, PAD_ID, dtype=ID_TYPE).tobytes()), slot
                data = plain.decompress(packed)
                buffer[2 * at : 2 * at + len(data)] = data
            slot_array = np.array(slot_of, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("start"),
                    pa.array(batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)),
                    batch.column("slot"),
                    pa.array(slot_array // slots),
                    pa.array(slot_array % slots * stride + 2 * batch.column("at").to_numpy(zero_copy_only=False).astype(np.int64)),
                ],
                names=["doc_id", "start", "length", "slot", "shard", "byte_offset"],
            )
        close()

    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    with store.open_output_stream(f"{folder}/shards.json") as out:
        about = {"sequences": sequences, "length": length, "slots": slots, "ids": ID_TYPE, "key": key, "total": total}
        out.write(json.dumps(about).encode())
    parts = staged.mapInArrow(cut, _PARTS)
    dealt = parts.repartitionById(shards, F.floor(F.col("slot") / slots).cast("int")).sortWithinPartitions("slot", "at")
    return dealt.mapInArrow(write, "doc_id bigint, start bigint, length bigint, slot bigint, shard bigint, byte_offset bigint")


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:08d}.bin"


def read_sequences(root: str, first: int = 0) -> Iterator[np.ndarray]:
    """The sequences in training order from slot `first` on: one seek, then files front to back."""
    store, folder = _store(root)
    with store.open_input_stream(f"{folder}/shards.json") as held:
        about = json.loads(held.read())
    stride = about["length"] * np.dtype(about["ids"]).itemsize
    for shard in range(first // about["slots"], -(-about["sequences"] // about["slots"])):
        start = max(first - shard * about["slots"], 0)
        with store.open_input_file(shard_path(folder, shard)) as held:
            held.seek(start * stride)
            while data := held.read(stride):
                yield np.frombuffer(data, dtype=about["ids"])


def shard_folder(spark) -> str:
    """A new folder for shards in the shared folder of the session."""
    return shared_dir(spark, "token-shards")
