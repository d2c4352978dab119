"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import discard, materialise


def component_of(links: DataFrame, a: str = "a", b: str = "b") -> tuple[DataFrame, int]:
    """``node, component`` for each node that has a link, ``component`` being one of its nodes, and the rounds it took.

    In each round nodes are ranked anew by a seeded hash, every node points to the least
    of itself and its neighbours, and the ends of the links are replaced by what they
    point to. As the ranks are as good as random, a round leaves at most three quarters
    of the nodes in the mean, and half of a chain, whatever the order of the ids; so
    rounds are logarithmic in the size of the largest component. Links, pointers
    and labels stay distributed, pointers are built with partial aggregation, and a node
    of high degree is one row a map task. Null ends and links of a node to itself are
    ignored, an empty table gives an empty result, repeated links count once.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels, rounds = None, 0
    while not edges.isEmpty():
        rounds += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(rounds), c), F.col(c).alias("to"))  # noqa: B023, E731
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = F.least(rank("a"), F.min(rank("b")))
        pointers = materialise(both.groupBy("a").agg(least.alias("least")).select(F.col("a").alias("node"), F.col("least.to").alias("to")), "pointers")
        at_a = pointers.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        at_b = pointers.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = edges.join(at_a, "a").join(at_b, "b").where("to_a <> to_b")
        before, edges = edges, materialise(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        discard(before)
        if labels is None:
            labels = pointers.withColumnRenamed("to", "component")
            labels.written_to = pointers.written_to
        else:
            step = pointers.select(F.col("node").alias("component"), "to")
            before, labels = labels, materialise(labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
            discard(before, pointers)
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels, rounds


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node for each node that has a link: columns ``node``, ``component``."""
    labels, _ = component_of(links, a, b)
    least = labels.groupBy("component").agg(F.min("node").alias("least"))
    return labels.join(least, "component").select("node", F.col("least").alias("component"))
