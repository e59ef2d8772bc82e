"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basewise.llm.common import settle
from basewise.operators.skew import splittable

MOST_ROUNDS = 60


def _with_least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``least``, the smallest of u and its neighbours v. Hot nodes are split."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("least"))
    left, right, condition = splittable(edges, least, [("u", "w")])
    return left.join(right, condition).select("u", "v", F.least("u", "least").alias("least"))


def _star(edges: DataFrame) -> DataFrame:
    """One round: hang larger neighbours, then smaller ones, on the smallest."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).where("v > u and v != least").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    small = _with_least(large)
    hung = small.select("u", F.col("least").alias("v")).unionByName(small.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v")))
    return hung.where("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and summed hash, to tell whether a round changed anything."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node with an edge to another.

    ``edges`` has two columns of integers; nulls and loops are left out, direction
    and repetition mean nothing. Each round is kept in the shared folder.
    """
    a, b = edges.columns
    current = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    current = settle(current)
    mark = _mark(current)
    for _ in range(MOST_ROUNDS):
        current = settle(_star(current))
        seen = _mark(current)
        if seen == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = seen
    raise RuntimeError("the stars did not settle")
