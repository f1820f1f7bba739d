"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.session import shared_dir

# White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"

BATCH_ROWS = 2000
# Cells of a sample's order: by its leading 12 bits.
ORDER_SHIFT = 52
BATCH_BYTES = 4 * 1024 * 1024
IDLE_SECONDS = 10.0


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in rows and bytes, so that a run of long texts fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_kept: dict[str, list] = {}


def worker_cache[T](key: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from batch to batch, such as a dictionary of words.

    A worker serves one stage after the other: what was not asked for of late goes when another key comes up.
    """
    if key not in _kept:
        let_go(IDLE_SECONDS)
        _kept[key] = [make(), 0.0]
    _kept[key][1] = time.monotonic()
    return _kept[key][0]


def let_go(seconds: float = 0.0) -> None:
    """Drop what this worker keeps and was not asked for in so many seconds; tasks that need the room begin with this."""
    since = time.monotonic() - seconds
    for key in [k for k, (_, at) in _kept.items() if at <= since]:
        del _kept[key]
    give_back()


def give_back() -> None:
    """Let the system have the memory that this worker has freed; the C library would hold tens of MB of it while the worker waits."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text as a string, NULL as the empty one."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))


def fold_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def windows(text: Column, key: Column, size: int, pieces: int = 16) -> Column:
    """The text where it has at most `size` characters, else `pieces` parts of it at hashed places, joined by blanks."""
    width = size // pieces
    at = [F.pmod(F.xxhash64(F.lit(n), key), F.length(text) - width) + 1 for n in range(pieces)]
    return F.when(F.length(text) <= size, text).otherwise(F.concat_ws(" ", *[F.substring(text, a, F.lit(width)) for a in at]))


def sample_order(doc_id: Column) -> Column:
    """A fixed pseudo-random order of rows, by which bounded training samples are taken."""
    return F.xxhash64(F.lit("sample"), doc_id)


def fresh(columns: list[str], name: str) -> str:
    """A working column name that no column of the input has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder, so that their true size is known to later joins."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def likely(rows: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """`rows` whose `key` is one of about `count` keys, and a few others, about one in 16: a filter before a shuffle, not a join.

    It goes by a bitmap of the keys' hashes that is sent to the tasks, of two bytes a key and at most 32 MB; beyond that it lets
    more rows pass.
    """
    bits = 1 << min(max(16 * count, 1 << 15).bit_length(), 28)
    number = F.pmod(F.xxhash64(F.lit("likely"), F.col(key)), F.lit(bits)) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bitmap"))
    position = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_bucket", F.bitmap_bucket_number(number)).join(F.broadcast(maps), "_bucket")
    return found.where(F.getbit(byte, (position % 8).cast("int")) == 1).select(*rows.columns)


def bounded_sample(rows: DataFrame, by: str, key: str, size: int, texts: DataFrame | None = None) -> DataFrame:
    """At most `size` rows for each value of `by`, in a fixed pseudo-random order of `key`, numbered `n` from 1.

    The keys are chosen from narrow rows and written; their number is bounded by `size` times the values
    of `by` (labels or languages), so they are sent to the tasks that read the texts and no text but the
    chosen ones moves. The texts come from `texts`, which has `key`, or from `rows` itself. Rows with a
    NULL key are left out; of rows that repeat a key with one value of `by` the smallest is taken, each task
    keeping one of them, so a key that a third of all rows repeat moves few texts.

    No task gets all keys of a value: they are first counted in cells of their order, and only those of
    the leading cells, which hold `size` keys or one cell more, are numbered.
    """
    first = Window.partitionBy(by).orderBy("_o", key)
    order = sample_order(F.col(key))
    keys = written(rows.select(by, key).where(F.col(key).isNotNull()).distinct().withColumns({"_o": order, "_cell": F.shiftright(order, ORDER_SHIFT)}), "keys")
    before = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keys.groupBy(by, "_cell").agg(F.count("*").alias("_n")).withColumn("_n", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    leading = keys.join(F.broadcast(cells.where(F.col("_n") < size)), [by, "_cell"], "left_semi")
    chosen = written(leading.withColumn("n", F.row_number().over(first)).where(F.col("n") <= size).select(by, key, "n"), "sample")
    found = (rows if texts is None else texts).join(F.broadcast(chosen), [by, key] if texts is None else key)
    others = [c for c in found.columns if c not in (by, key, "n")]
    if not others:
        return found.distinct()
    return found.groupBy(by, key, "n").agg(F.min(F.struct(*others)).alias("_row")).select(by, key, "n", "_row.*")
