"""Connected components of a graph given as edges, by repeated shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.session import stored


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Rows (node, root) for every node of the edges: the root is the smallest node of its component.

    Alternates two star steps until nothing changes: every node's larger neighbours are linked to the
    smallest neighbour, then its smaller neighbours are. Both combine by node with a minimum, which is
    computed before the shuffle, and join on the node; each round is written to the shared folder, so
    the lineage stays short. The number of rounds grows with the logarithm of a component's size.
    """
    links = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    files = max(8, links.count() // 500_000)  # rounds only shrink the table
    before = None
    while True:
        links = _large_star(links, files)
        links, size = _small_star(links, files)
        if size == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = size


def _large_star(links: DataFrame, files: int) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
    least = stored(least.select("k", F.least("k", "m").alias("m")).coalesce(files), "least")
    larger = both.where("v > u").join(least, F.col("u") == F.col("k"))
    return stored(larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(files), "links")


def _small_star(links: DataFrame, files: int) -> tuple[DataFrame, tuple]:
    """Link each node's smaller neighbours, and the node, to the smallest of them."""
    least = stored(links.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).coalesce(files), "least")
    joined = links.join(least, F.col("u") == F.col("k"))
    lower = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(F.col("k").alias("u"), F.col("m").alias("v"))
    links = stored(own.unionByName(lower).distinct().coalesce(files), "links")
    # A sum of hashes tells two rounds apart; wrapping decimals keep it exact.
    mark = links.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return links, (mark["n"], mark["h"])
