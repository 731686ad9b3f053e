"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node's smaller neighbours, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each node of an edge can reach.

    Alternates large-star and small-star steps, so a path of n nodes takes about log n
    rounds; every step groups with partial aggregation and joins on the node, where AQE
    splits hubs. Each round is a written table, so a lost executor costs one round.
    Edges with a null end are left out; self-loops give a component of one.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        if not state[0]:
            break
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).unionByName(loops.join(stars, "node", "left_anti")).distinct()
    return stars.unionByName(roots.select("node", F.col("node").alias("component")))
