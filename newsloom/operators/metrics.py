"""Row counts of a run: category distribution and the step funnel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def category_distribution(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Rows per tag, most frequent first."""
    return df.groupBy(tag).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(tag))


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """One row per filter step with the rows before, after and removed, from one pass.

    Steps apply in the given order: a row reaches a step when it passed all earlier ones.
    """
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_0")]
    for i, condition in enumerate(steps.values(), start=1):
        passed = passed & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(passed).alias(f"_{i}"))
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"_{i - 1}").alias("rows_before"),
            F.col(f"_{i}").alias("rows_after"),
            (F.col(f"_{i - 1}") - F.col(f"_{i}")).alias("removed"),
        )
        for i, name in enumerate(steps, start=1)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def observed(df: DataFrame, name: str, **flags: Column) -> tuple[DataFrame, Observation]:
    """The same rows with counters that fill while the job runs: all rows and one per flag."""
    observation = Observation(name)
    counters = [F.count_if(condition).alias(flag) for flag, condition in flags.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counters), observation
