"""Connected components of an edge table, by contraction: joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _undirected(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller end first; no loops."""
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, work) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``): the smallest node of its component.

    Each round gives every node the name of the first one among itself and its neighbours, in an order that is drawn anew for
    each round, and edges run between names from then on; those inside a name go. A round leaves a share of the names, however
    they are linked, so the rounds grow with the logarithm of the largest component. A round's tables are written out. Nothing is gathered
    per node, so a node with very many neighbours costs partial minima and join rows that Spark may split.
    """
    edges = work.stage(_undirected(edges.select("a", "b")), "edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    names = work.stage(nodes.select("node", F.col("node").alias("root")), "names")
    rounds = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        drawn = lambda c: F.struct(F.xxhash64(c, F.lit(rounds)).alias("order"), F.col(c).alias("to"))  # noqa: B023, E731
        least = both.groupBy("a").agg(F.min(drawn("b")).alias("_first"))
        least = work.stage(least.select(F.col("a").alias("root"), F.least(drawn("a"), "_first")["to"].alias("to")), "least")
        rounds += 1
        ends = {end: least.select(F.col("root").alias(end), F.col("to").alias(f"_{end}")) for end in ("a", "b")}
        renamed = edges.join(ends["a"], "a").join(ends["b"], "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = work.stage(_undirected(renamed), "edges")
        names = work.stage(
            names.join(least, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "names"
        )
    smallest = names.groupBy("root").agg(F.min("node").alias("_least"))
    return work.stage(names.join(smallest, "root").select("node", F.col("_least").alias("root")), "components")
