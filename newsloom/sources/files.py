"""Tables under a path that may not have been written yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_stored(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at `path`; None where there is none, any other failure is an error.

    A declared schema also reads a table to which only empty batches have been appended; without one
    such a table counts as not written.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", *(() if schema else ("UNABLE_TO_INFER_SCHEMA",))):
            return None
        raise
