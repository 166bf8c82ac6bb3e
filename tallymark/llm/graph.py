"""Connected components, and joins whose small side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark import staging
from tallymark.staging import discard, stage

BROADCAST_ROWS = 4_000_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back, its columns nullable."""
    return stage(df, name)


def measured(df: DataFrame, name: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` (few narrow columns), staged and counted: broadcast up to `most` rows, else shuffled."""
    return staging.measured(df, name, most)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a vertex is tied to the vertex's least neighbour."""
    both = edges.union(edges.select("v", "u")).toDF("x", "y")
    least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
    return both.filter("y > x").join(least, "x").filter("y != m").select(
        F.col("y").alias("u"), F.col("m").alias("v")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its neighbours below it are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): the least vertex reachable over `edges` (columns u, v; any order).

    Alternating large and small stars; every round is a written table. The loop ends when each
    vertex is either the centre of a star or tied to one centre. Vertices without an edge to another
    vertex are left out.
    """
    current = staged(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    while True:
        ends = current.select(F.col("u").alias("x"), F.lit(1).alias("tied"), F.lit(0).alias("centre")).union(
            current.select("v", F.lit(0), F.lit(1))
        ).groupBy("x").agg(F.sum("tied").alias("tied"), F.max("centre").alias("centre"))
        if ends.filter("tied + centre > 1").isEmpty():
            return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
            )
        older, current = current, staged(_small_star(_large_star(current)).distinct(), "edges")
        discard(older)
