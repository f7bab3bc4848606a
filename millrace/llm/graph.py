"""Connected components of links between nodes, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch


def components(links: DataFrame, scratch: Scratch, rounds: int = 100) -> DataFrame:
    """node -> root (the smallest node of its component) for every node of ``links`` (columns u, v).

    Alternates large-star and small-star: in each, a node's neighbours are tied to the smallest of
    them. Minima are aggregated before the shuffle and joined back, so a node with very many links is
    spread over tasks. Every round is written; it ends when a round changes nothing.
    """
    both = lambda e: e.union(e.select("v", "u"))
    edges = scratch.keep(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges0")
    seen, last = None, "edges0"
    for i in range(1, rounds):
        # large star: neighbours above a node are tied to the smallest of the node and its neighbours
        all_ = both(edges)
        least = all_.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = all_.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.keep(large, f"large{i}")
        # small star: a node and its neighbours below it are tied to the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        tied = large.join(least, F.col("u") == F.col("w"))
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("w", "m")).where("u <> v").distinct()
        edges = scratch.keep(small, f"edges{i}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(last, f"large{i}")
        last = f"edges{i}"
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
