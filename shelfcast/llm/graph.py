"""Connected components over an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

MAX_ROUNDS = 40


def _star(edges: DataFrame, name: str) -> DataFrame:
    """Link every neighbour of a node to the least of the node and its neighbours.

    Minima are partial aggregates and come back by a join, whose hot keys Spark
    splits; no neighbour list is ever gathered.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if name == "large":
        out = joined.filter("b > a").selectExpr("b as a", "m as b")
    else:
        out = joined.selectExpr("b as a", "m as b").unionByName(least.selectExpr("a", "m as b"))
    return written(out.filter("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(),
                   f"star-{name}")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component."""
    edges = written(edges.filter("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        edges = _star(_star(both, "large"), "small")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.selectExpr("a as node", "b as root").unionByName(
        edges.selectExpr("b as node", "b as root").distinct())
