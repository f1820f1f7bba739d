"""Feed items and stored pages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

FEED_SCHEMA = StructType(
    [
        StructField(name, StringType())
        for name in ("link", "title", "snippet", "domain", "source", "date_utc", "country", "query", "scraped_at")
    ]
)


def read_feed(spark: SparkSession, path: str | list[str], fmt: str = "json", schema: StructType = FEED_SCHEMA) -> DataFrame:
    """Feed items with a declared schema: absent fields are NULL, empty data adds nothing."""
    return spark.read.schema(schema).format(fmt).load(path)


def stream_feed(
    spark: SparkSession, path: str, fmt: str = "json", schema: StructType = FEED_SCHEMA, **options: str
) -> DataFrame:
    """The same feed as a stream of new files."""
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def union_feeds(feeds: Iterable[DataFrame]) -> DataFrame:
    """All feeds by column name; columns that a feed lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)
