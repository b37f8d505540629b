"""Connected components of a table of links, in a few rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyloom.session import durable

_EDGES = "u long, v long"


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one task as stars around the smallest node of each of its components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for frame in frames:
        for u, v in zip(frame["u"].tolist(), frame["v"].tolist()):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    stars = [(x, root(x)) for x in parent]
    stars = [(x, r) for x, r in stars if x != r]
    for at in range(0, len(stars), 100_000):
        yield pd.DataFrame(stars[at : at + 100_000], columns=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether the links are stars: no node has two centers, and no center has one of its own."""
    seen = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    per_node = seen.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return per_node.where('out > 1 OR (out = 1 AND "in" = 1)'.replace('"', "`")).isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` for every node with a link to another; the label is the smallest node reached.

    Each task first turns its own links into stars.  Large-star and small-star rounds then join the
    stars; their number grows with the logarithm of a component's size.  Each round is stored, and
    the work ends when only stars are left.  Links of a node to itself are ignored.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges = durable(ends.mapInPandas(_forest, _EDGES), "links")
    while not _is_settled(edges):
        edges = durable(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
