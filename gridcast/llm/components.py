"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.session import materialize

MAX_ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: larger (or smaller) neighbours of each node are linked to its least neighbour.

    The least neighbour is an aggregate joined back, so a node with very many
    neighbours is never one task's group.
    """
    pairs = _both_ways(links)
    if not large:
        pairs = pairs.where("v < u")
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = pairs.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): the least node that links reach. Each round is a written table."""
    links = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        links = materialize(_star(_star(links, True), False), "stars")
        now = _state(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
