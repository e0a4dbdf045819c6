"""Connected components of a graph given by its edges.

Large-star and small-star steps alternate until nothing changes; each step is an
aggregation and a join, written to the shared folder, so the number of rounds grows with
the logarithm of the graph and a lost executor costs its tasks only. A node with very
many neighbours is an aggregate and a join key that Spark can split. Smallest neighbours
of a small graph are broadcast, which spares the shuffles of its joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup


BROADCAST_EDGES = 100_000


def _told(edges: DataFrame, low: DataFrame, small: bool) -> DataFrame:
    """``edges`` with the smallest neighbour of their ``u``."""
    return edges.join(F.broadcast(low), "u") if small else lookup(edges, low, ["u"], "inner")


def _written(edges: DataFrame, tables: Tables) -> tuple[DataFrame, tuple]:
    back = tables.keep(edges.distinct(), "edges")
    sums = back.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return back, tuple(sums)


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low"))
    return _told(both.where("v > u"), low, small).select(F.col("v").alias("u"), F.least("u", "low").alias("v"))


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    tied = _told(down, low, small).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return tied.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node can reach; ``links`` is (a, b)."""
    tables = Tables(links.sparkSession)
    edges, before = _written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), tables)
    while before[0]:
        small = before[0] <= BROADCAST_EDGES
        edges, now = _written(_small_star(_large_star(edges, small), small), tables)
        if now == before:
            break
        before = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
    labels = Tables(links.sparkSession).keep(labels, "labels")
    tables.discard()
    return labels


def folded(labels: DataFrame | None, merged: DataFrame) -> DataFrame:
    """(node, label) after the labels themselves were linked: ``merged`` has the new label of each label, or of a
    node that had no links before, that has one."""
    if labels is None:
        return merged
    news = merged.select(F.col("node").alias("label"), F.col("label").alias("now"))
    told = lookup(labels, news, ["label"]).select("node", F.coalesce("now", "label").alias("label"))
    return told.unionByName(merged.join(labels.select("node"), "node", "left_anti"))
