"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.session import materialize, release


def _to_least(pairs: DataFrame, only_above: bool) -> DataFrame:
    """Link every node's neighbours to the least of them and it; with `only_above`, those above the node.

    The least neighbour is a grouped minimum, so a node with very many neighbours is added up in part
    before the shuffle, and joining it back is a plain join, which Spark splits where it is skewed.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    linked = pairs.join(least, "u")
    if only_above:
        return linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    below = linked.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return below.unionByName(own)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every node that has an edge, with the least node of its component: (node, component).

    Alternates two steps until every node is linked to one root and roots to none: each node's larger
    neighbours are linked to its least neighbour, then each node and its smaller neighbours are. Paths halve, so rounds grow with the
    logarithm of the longest path. Rows with a null end and loops are ignored; no edges, no rows.
    """
    links = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u") > F.col("v"))
        .distinct()
    )
    links = materialize(links, "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, only_above=True).filter(F.col("u") > F.col("v")).distinct()
        small = _to_least(large, only_above=False).filter(F.col("u") > F.col("v")).distinct()
        after = materialize(small, "links")
        chained = after.join(after.select(F.col("v").alias("u")), "u", "left_semi")
        torn = after.groupBy("u").agg(F.count("*").alias("roots")).filter("roots > 1")
        settled = chained.isEmpty() and torn.isEmpty()
        release(links)
        links = after
        if settled:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
