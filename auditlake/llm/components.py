"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlake.operators.lookup import free, materialize


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) edges; the component is its least
    node. Each round joins every edge with its end's least neighbour (large star,
    then small star) and writes the edges (the given ones too), until they point at their component's
    least node and no longer change; a round's tables go after the next one. Only sums of an edge hash
    reach the driver."""
    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        out, seen = materialize(df, "edges", n=F.count(F.lit(1)), h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        return out, (seen["n"], seen["h"])

    # a round reads its edges several times: what makes them runs once, for this table
    edges, _ = materialize(edges.where("a != b").select("a", "b"), "edges-in")
    now, sign = written(small_star(edges))
    free(edges)
    before = None
    while sign != before and sign[0]:
        before = sign
        large, _ = written(large_star(now))
        free(now)
        now, sign = written(small_star(large))
        free(large)
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component")))
