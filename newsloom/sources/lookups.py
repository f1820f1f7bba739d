"""Persisted key-value caches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from newsloom.sources.files import read_stored

LOOKUP_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType())])
STORED_SCHEMA = StructType([*LOOKUP_SCHEMA.fields, StructField("written_at", TimestampType())])
GENERATION_SCHEMA = StructType([StructField("generation", IntegerType())])


def json_lookup(df: DataFrame, json: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON objects as (key, value) rows; unreadable text and empty objects add nothing."""
    parsed = F.from_json(F.col(json), "map<string,string>")
    return df.select(*keep, F.explode(parsed).alias("key", "value"))


def _generation(spark: SparkSession, path: str) -> int:
    """The number of the folder that holds the cache: 0 until it has been compacted."""
    switched = read_stored(spark, f"{path}-generations", GENERATION_SCHEMA)
    return 0 if switched is None else switched.agg(F.max("generation")).first()[0] or 0


def _folder(path: str, generation: int) -> str:
    return f"{path}-{generation}" if generation else path


def _newest(stored: DataFrame) -> DataFrame:
    """One row per key: key, value and written_at of the newest entry.

    Entries written before they had a stamp count as the oldest; of entries with one stamp, filled ones
    come before blank ones.
    """
    age = F.struct(F.coalesce("written_at", F.lit(datetime(1970, 1, 1))), F.coalesce(F.col("value"), F.lit("")) != "", "value")
    return stored.groupBy("key").agg(F.max_by(F.struct("value", "written_at"), age).alias("_entry")).select("key", "_entry.*")


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of each key in the cache at `path`; one that was never written is empty."""
    stored = read_stored(spark, _folder(path, _generation(spark, path)), STORED_SCHEMA)
    return spark.createDataFrame([], LOOKUP_SCHEMA) if stored is None else _newest(stored).select("key", "value")


def save_lookup(entries: DataFrame, path: str) -> None:
    """Append entries with the time of writing; a later entry of a key replaces the earlier ones on loading."""
    folder = _folder(path, _generation(entries.sparkSession, path))
    named = entries.select(F.col("key").cast("string"), F.col("value").cast("string"))
    named.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(folder)


def compact_lookup(spark: SparkSession, path: str) -> str:
    """Write the newest entry of each key to a folder of its own, switch readers to it, and name the folder left behind.

    The switch is one row that is appended when the folder is complete, so a run that fails changes nothing
    and may be repeated. Entries saved while it runs would stay in the folder left behind.
    """
    now = _generation(spark, path)
    stored = read_stored(spark, _folder(path, now), STORED_SCHEMA)
    if stored is not None:
        _newest(stored).write.mode("overwrite").parquet(_folder(path, now + 1))
        spark.createDataFrame([(now + 1,)], GENERATION_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}-generations")
    return _folder(path, now)
