"""Connected components of a distributed edge list, by alternating large-star and small-star steps.

Each node ends in a star around the smallest id of its component. An edge list is only grouped by node with
``min`` and joined back, so a node with very many neighbours is pre-aggregated and its join side can be split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b): every neighbour on the step's side is linked to the least neighbour."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node that has an edge; ``edges`` has two columns a and b of one id type.

    Self-links, repeated edges and either direction are fine; an empty list gives an empty table."""
    now = scratch.save(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        step = scratch.save(_star(_star(now, True), False), "edges")
        said = step.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = step
        if before == said:
            break
        before = said
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
