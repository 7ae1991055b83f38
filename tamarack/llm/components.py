"""Connected components over a table of links, by contraction towards nodes of least hash.

Every node points to the one of least hash among itself and its neighbours; links are
drawn between what their ends point to, and the rest of the graph is contracted again,
until no link is left. A star takes at most three rounds, a chain a number that grows
with the logarithm of its length. Nothing is collected; each round's tables are stored
in the shared folder. A node that very many rows name is the one row of its side of
each join, so that Spark splits its partition (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize


def priority(node: str) -> Column:
    """The order in which nodes are preferred."""
    return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of links (u, v); the root is the component's least node. A link may be repeated or a loop."""
    edges = materialize(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u != v").distinct(), "edges")
    nodes = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min(priority("v")).alias("best")).select("u", F.least("best", priority("u"))["node"].alias("parent"))
        parents = materialize(nearest, "parents")
        once = edges.join(parents, "u").select(F.col("parent").alias("a"), F.col("v").alias("u"))
        twice = once.join(parents, "u").select(F.least("a", "parent").alias("u"), F.greatest("a", "parent").alias("v"))
        if nodes is None:
            nodes = parents.select(F.col("u").alias("node"), F.col("parent").alias("at"))
        else:
            moves = parents.withColumnRenamed("u", "at")
            nodes = materialize(nodes.join(moves, "at", "left").select("node", F.coalesce("parent", "at").alias("at")), "nodes")
        edges = materialize(twice.where("u != v").distinct(), "edges")
    if nodes is None:
        return links.select(F.col("u").alias("node"), F.col("u").alias("root")).where("false")
    roots = nodes.groupBy("at").agg(F.min("node").alias("root"))
    return nodes.join(roots, "at").select("node", "root")
