"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
ROW_ID = "_row_id"

# The library reads and writes UTC instants and converts to the local zone explicitly.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A staged table goes when no DataFrame reads it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Without the call site of every column expression, plans of many expressions build much faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "newsloom", **conf: str) -> SparkSession:
    """A session with the library's settings; the master and sizes come from the cluster or `conf`."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as the session names it.

    Local sessions without the setting get a temporary folder; a cluster without it is an error,
    as executors on other machines could not see a driver-local folder.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="newsloom-")
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder, so that later steps do not compute them again."""
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder, whose true size later joins go by."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def with_row_ids(rows: DataFrame) -> DataFrame:
    """The rows staged, each with a number of its own that stays the same however often they are read."""
    return stage(rows.withColumn(ROW_ID, F.monotonically_increasing_id()))
