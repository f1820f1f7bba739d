"""Append-only target tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from newsloom.operators.columns import conform
from newsloom.sources.files import read_stored
from newsloom.sources.sheets import resolve_key_column

INGEST_DAY = "ingest_day"
BUCKET = "bucket"


def target_schema(header: Sequence[str], key: str = "link_key") -> StructType:
    return StructType([StructField(name, StringType()) for name in [*header, key]])


def bucket_of(key: Column, buckets: int) -> Column:
    """The part of a bucketed target that a key belongs to."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def stored_names(spark: SparkSession, path: str, header: Sequence[str], key: str = "link_key") -> dict[str, str]:
    """How a table kept under a header of its own calls the columns of `header`: by name, in any case, or by position.

    Empty where there is no table, or where nothing differs but the case. Partition columns and the key
    are not part of the header.
    """
    table = read_stored(spark, path)
    own = [] if table is None else [c for c in table.columns if c.lower() not in (INGEST_DAY, BUCKET, key)]
    by_name = {c.lower() for c in own} & set(header)
    found = {name: resolve_key_column(own, name, header) for name in header if name not in by_name}
    return {name: spelled for name, spelled in found.items() if spelled and spelled.lower() not in by_name}


def read_target(
    spark: SparkSession, path: str, header: Sequence[str], key: str = "link_key", since: date | None = None,
    buckets: int | None = None, batch: DataFrame | None = None, names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The target table; one that was never written is empty, any other failure is an error.

    `since` prunes to the ingest days from that date on, for feeds with a fixed horizon. Of a target laid
    out in `buckets`, only those that the keys of `batch` belong to are read; at most `buckets` numbers
    go through the driver. `names` are the table's own names of header columns (`stored_names`).
    """
    names = names or {}
    schema = target_schema([names.get(name, name) for name in header], key)
    if buckets:
        schema = schema.add(BUCKET, IntegerType())
    schema = schema.add(INGEST_DAY, DateType())
    table = read_stored(spark, path, schema)
    if table is None:
        table = spark.createDataFrame([], schema)
    elif buckets and batch is not None:
        table = table.where(F.col(BUCKET).isin([r[0] for r in batch.select(bucket_of(F.col(key), buckets)).distinct().collect()]))
    table = table.withColumnsRenamed({own: name for name, own in names.items()})
    return table.where(F.col(INGEST_DAY) >= F.lit(since)) if since else table


def append_new(
    rows: DataFrame, path: str, header: Sequence[str], ingest_day: date, key: str = "link_key",
    max_records: int | None = None, buckets: int | None = None, names: Mapping[str, str] | None = None,
) -> None:
    """Append rows in header order under their ingest day, by the table's own `names` where it has such.

    `max_records` bounds the rows per file where small batches are wanted. With `buckets`, the rows lie
    in that many folders by the hash of their key, which later batches read by number; a table keeps the
    number it began with.
    """
    out = conform(rows, [*header, key]).withColumnsRenamed(dict(names or {})).withColumn(INGEST_DAY, F.lit(ingest_day))
    parts = [INGEST_DAY]
    if buckets:
        # Dealt by bucket, so that a batch writes one file to each that it touches.
        out = out.withColumn(BUCKET, bucket_of(F.col(key), buckets)).repartition(BUCKET)
        parts = [BUCKET, INGEST_DAY]
    writer = out.write.mode("append").partitionBy(*parts)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)
