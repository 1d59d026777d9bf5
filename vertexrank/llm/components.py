"""Connected components of a link table by distributed union-find.

Alternates two star operations over the edge table until it is a forest of
stars (Kiveris et al., "Connected components in MapReduce and beyond"): the
large star links every larger neighbour of a vertex to the smallest
neighbour, the small star does so for the smaller neighbours. Every step is a
partial aggregate and an equi-join; the table of each round is written to
the shared folder, so a lost executor costs one round and both join sides are
plain scans that adaptive execution can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id on a link (columns ``a, b``, same
    orderable type, any direction, repeats and self links allowed);
    ``component`` is the smallest id reachable. Ids without links are absent."""
    edges = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return cut(stars.unionByName(roots))
