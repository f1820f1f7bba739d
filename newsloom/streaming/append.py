"""Incremental append: clean each micro-batch and add what the target lacks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom.functions.dates import ZONE, recent, to_local
from newsloom.operators.joins import only_new
from newsloom.sources.tables import append_new, read_target


def append_batch(
    clean: Callable[[DataFrame], DataFrame],
    path: str,
    header: Sequence[str],
    ingest_day: Callable[[], date],
    key: str = "link_key",
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` body that may run twice on the same batch and adds its rows once.

    Rows that an earlier attempt has written are found in the target, so a replay is harmless.
    """

    def run(batch: DataFrame, _batch_id: int) -> None:
        rows = clean(batch).persist()
        try:
            target = read_target(batch.sparkSession, path, header, key)
            append_new(only_new(rows, target, key, narrow=True), path, header, ingest_day(), key)
        finally:
            rows.unpersist()

    return run


def incremental_append(
    items: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str, hourly: bool = False
) -> StreamingQuery:
    """Start the stream: every hour, or once over all that is available."""
    writer = items.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 hour") if hourly else writer.trigger(availableNow=True)).start()


def recent_items(items: DataFrame, today: date, stamp: str, days_back: int = 1, zone: str = ZONE) -> DataFrame:
    """Stateless recency rule for streams by the local day: late items drop before any state."""
    return items.where(recent(F.to_date(to_local(F.col(stamp), zone)), today, days_back))
