"""Connected components of a graph that no one machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import dealt_anew, durable


def _swap(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.unionByName(_swap(edges))
    least = dealt_anew(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "n", "u").select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest."""
    least = dealt_anew(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "n", "u").select("u", "m")
    handed = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links(a, b)``; component is the smallest node.

    Alternates the two star operations until no edge changes; each round is
    written to the shared checkpoint folder. Minima are combined before they
    are shuffled, so a node with very many links is no hot group; the joins
    split on skew. Links of a node to itself or with a null count for nothing;
    repeated links count once; no links give an empty result.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, seen = durable(edges), None
    while True:
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        edges = durable(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
