"""Connected components of a link table, by the smallest node of each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import written


def union_find(edges: pd.DataFrame) -> pd.DataFrame:
    """Each node of a block of links with the smallest node it reaches there, the roots themselves left out."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for u, v in zip(edges["u"].tolist(), edges["v"].tolist()):
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    made = pd.DataFrame({"u": pd.Series(nodes, dtype="int64"), "v": pd.Series([root(x) for x in nodes], dtype="int64")})
    return made[made["u"] != made["v"]]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` for every node that is not the smallest of its component.

    Blocks of links are first merged by union-find within their tasks; the forests that are left are
    turned into stars by alternating large-star and small-star steps, each round written to the shared
    folder. It ends when a round changes nothing.
    """

    def merge(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            yield union_find(block)

    def state(links: DataFrame) -> tuple:
        row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    forest = written(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInPandas(merge, "u bigint, v bigint").distinct(), "forest")
    before = state(forest)
    while before[0]:
        forest = written(_small_star(_large_star(forest)), "forest")
        now = state(forest)
        if now == before:
            break
        before = now
    return forest.select(F.col("u").alias("node"), F.col("v").alias("component"))
