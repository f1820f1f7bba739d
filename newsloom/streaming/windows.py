"""Bounded deduplication and windowed counts over a stream of items."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampType

from newsloom.functions.dates import ZONE, digest_slot, slot_date, to_local
from newsloom.operators.dedupe import first_rows


def dedupe_stream(items: DataFrame, key: str, stamp: str, horizon: str = "2 days") -> DataFrame:
    """One row per key within the horizon; the state of older keys is dropped.

    The append to a keyed target is exact for ever; this form trades that for bounded state.
    """
    return items.withWatermark(stamp, horizon).dropDuplicatesWithinWatermark([key])


def digest_windows(items: DataFrame, stamp: str, keys: Sequence[str], delay: str = "1 day", offset: str = "12 hours") -> DataFrame:
    """Counts per day window that opens at 09:00 local (12:00 UTC) and per key."""
    window = F.window(stamp, "1 day", "1 day", offset)
    return (
        items.withWatermark(stamp, delay)
        .groupBy(window, *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")
    )


def slot_end(local: Column) -> Column:
    """The local time at which the mailed slot of a stamp closes."""
    hours = F.when(digest_slot(local) == "08-13", 13).when(digest_slot(local) == "13-18", 18).otherwise(8)
    return slot_date(local).cast("timestamp") + F.make_dt_interval(hours=hours)


def slot_counts(items: DataFrame, stamp: str, keys: Sequence[str], delay: str = "1 day", zone: str = ZONE) -> DataFrame:
    """Running counts per mailed slot and key.

    The slot's end is the event time: a slot is one group, and its state goes once the watermark has
    passed its end. Items that come more than `delay` after that are late.
    """
    local: Column = to_local(F.col(stamp), zone)
    return (
        items.withColumns({"slot_end": slot_end(local), "slot_date": slot_date(local), "slot": digest_slot(local)})
        .withWatermark("slot_end", delay)
        .groupBy("slot_end", "slot_date", "slot", *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's updated counts under the batch's number; writing a batch again changes nothing."""

    def append(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("append").parquet(path)

    writer = counts.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest_counts(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last count of each group: at the end of the input every item is counted once, open windows included."""
    return written.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def first_in_order(items: DataFrame, key: str, order: Sequence[str], horizon: timedelta = timedelta(days=2), delay: str = "1 day") -> DataFrame:
    """The first row of every key in `order`, whose first column is the event time, and again after each horizon.

    A key's period begins with its first row; rows that begin before the period's end are copies, the next
    one opens a new period. A row that arrives late and comes before the period's first replaces it: it is
    passed on as well, and `first_of_periods` keeps the one that counts. State is one row per key and goes
    when the watermark has passed the period's end. Rows without a key or time are left out.

    Which rows of a key open a period depends on all earlier ones, so a key's rows of one micro-batch meet
    in one task; the source's limit per trigger (`maxFilesPerTrigger`) bounds them.
    """
    stamp, names = order[0], items.columns
    fields = {f.name: f for f in items.schema}
    out = StructType([*items.schema.fields, StructField("period", TimestampType())])
    kept = StructType([StructField("period", TimestampType()), *[StructField(f"first_{n}", fields[c].dataType) for n, c in enumerate(order)]])
    span = pd.Timedelta(horizon)

    def run(_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(list(order), kind="stable")
        period, first = (state.get[0], tuple(state.get[1:])) if state.exists else (None, None)
        period = None if period is None else pd.Timestamp(period)
        if first is not None:
            first = (pd.Timestamp(first[0]), *first[1:])
        taken, periods = [], []
        for at, place in enumerate(zip(*(rows[c] for c in order))):
            if period is None or place[0] >= period + span:
                period, first = place[0], place
            elif place < first:
                first = place
            else:
                continue
            taken.append(at)
            periods.append(period)
        state.update((period.to_pydatetime(), first[0].to_pydatetime(), *[p.item() if hasattr(p, "item") else p for p in first[1:]]))
        state.setTimeoutTimestamp(max(int((period + span).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[taken].assign(period=periods)[[*names, "period"]]

    usable = items.where(F.col(key).isNotNull() & F.col(stamp).isNotNull()).withWatermark(stamp, delay)
    return usable.groupBy(key).applyInPandasWithState(run, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def first_of_periods(written: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of what `first_in_order` has passed on, the row that counts of each key and period."""
    return first_rows(written, [key, "period"], list(order)).drop("period")
