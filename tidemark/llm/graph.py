"""Connected components of links by Spark joins: alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.scratch import measured


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _towards(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """Every neighbour of a node is linked with the node's least neighbour (or the node itself).

    The minimum is combined before the shuffle and is unique by node, so a node with very many links is a matter of
    skew in a plain join, which adaptive execution splits.
    """
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = edges.join(least, "a")
    if keep_larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links(a, b)`` that is not its own root; root is the least node reachable.

    Each round links nodes above with the least neighbour, then nodes below; rounds grow with the logarithm of the
    longest chain. Every round is a written table, so a lost executor costs one round.
    """
    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        table, seen = measured(
            df, label, total=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), least=F.min("a"), most=F.max("b")
        )
        return table, (seen["rows"], seen["total"])

    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = written(ordered)
    while state[0]:
        starred = _towards(_both(edges), keep_larger=True)
        fresh, now = written(_towards(starred.filter("b < a"), keep_larger=False))
        edges = fresh
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
