"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faresift.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(node, root))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node on its smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    return (
        both.join(least, "node")
        .filter("root > node")
        .select(F.col("root").alias("node"), F.least("least", "node").alias("root"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    joined = edges.join(least, "node")
    return joined.select(
        F.when(F.col("root") == F.col("least"), F.col("node")).otherwise(F.col("root")).alias("node"),
        F.col("least").alias("root"),
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root): every node that has a link, with the smallest node it can reach (a root: itself).

    Links are undirected; loops, repeated links and nulls do not matter. Each round is written to the
    shared folder. A node of any degree is only met by a partial minimum and an equi-join.
    """
    edges = (
        links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("root"))
        .filter("node <> root")
        .distinct()
    )
    edges = materialise(edges, "edges")
    state, before = _state(edges), None
    while state != before:
        edges = materialise(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        state, before = _state(edges), state
    roots = edges.select(F.col("root").alias("node"), "root").distinct()
    return edges.union(roots)
