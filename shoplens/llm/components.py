"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.llm.storage import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .filter("u <> v")
    )


def components(links: DataFrame, scratch: Scratch, label: str = "links") -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Large-star and small-star steps alternate until nothing changes (Kiveris and others, 2014). A
    node with very many links costs no more than they do: its minimum is aggregated before the
    shuffle and joined back. Self links and repeated links are harmless, NULL ends are dropped.
    """
    edges = (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    while True:
        edges = scratch.store(edges, label)
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            break
        state = now
        edges = _small_star(_large_star(edges).distinct()).distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
