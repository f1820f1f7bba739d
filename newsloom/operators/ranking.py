"""Positions inside groups that may be too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stage


def ordered_position(df: DataFrame, group: Sequence[str], lead: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The 1-based position of every row in its group, ordered by `lead`, then by `order`; NULLs come first.

    Only these columns are sorted: a sampled range split of their full order deals them to tasks, whatever
    columns have many equal values, and staged rows are numbered where they lie. A row's position is its
    number in its task, less that of the group's first row there, plus the group's rows in earlier tasks.
    The other columns are joined to it once, by the same columns, which must tell the rows of a group apart;
    rows that are equal in all of them get the first of their places.
    """
    keys = [*group, *lead, *order]
    ranged = df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    staged = stage(ranged.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    cells = staged.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n").alias("o")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*group, "_part"]]
    position = F.min(F.col("_before") + F.col("_row") - F.col("_first") + 1).cast("bigint").alias(name)
    placed = staged.alias("s").join(offsets, same).groupBy(*[F.col(f"s.{c}") for c in keys]).agg(position).alias("p")
    match = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in keys]
    # Rows with long texts are never broadcast; Spark takes computed texts for short ones.
    return df.alias("d").hint("merge").join(placed, match).select(*[F.col(f"d.{c}") for c in df.columns], F.col(f"p.{name}"))
