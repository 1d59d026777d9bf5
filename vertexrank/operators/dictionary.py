"""Dense vertex ids: a distributed dictionary from any key to 0 .. n-1 (BIGINT).

Every step of the loop shuffles vertex ids. With URLs or other long strings for
ids, most of the shuffled bytes are ids; with a dictionary the loop carries eight
bytes a vertex. Ids follow the order of the keys, so the same edges always give
the same ids, and neighbours in the key order (pages of one host) are neighbours
as numbers.

The dictionary is numbered by range partition: rows are sorted within ranges, and
a range starts where the counts of all earlier ones end (``number_rows``); no row
passes through one task or the driver. Edges meet it once per end; keys with more
than an even share of the edges are joined by broadcast, at most one per
partition (``join_source``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut_lineage, keep
from .order import number_rows
from .topology import degree_table, join_source

PLACE_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def vertex_dictionary(edges: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``vertex, id, out_degree, in_degree`` of every vertex of clean, distinct
    ``edges``; ``id`` is 0 for the smallest vertex, then consecutive."""
    degrees = degree_table(edges).select("vertex", "out_degree", "in_degree")
    return number_rows(degrees, ["vertex"], "id", num_partitions)


def vertex_numbers(edges: DataFrame) -> DataFrame:
    """The columns of :func:`vertex_dictionary`, with ids that are only distinct and small:
    the place of a row in its partition and the partition, written once. No sort, and
    another run may number the vertices differently."""
    degrees = degree_table(edges).select("vertex", F.monotonically_increasing_id().alias("id"), "out_degree", "in_degree")
    placed = cut_lineage(degrees)
    part = F.shiftright("id", PLACE_BITS)
    parts = int(placed.agg(F.max(part)).first()[0] or 0) + 1
    place = F.col("id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn("id", place * F.lit(parts).cast("long") + part)


def encode_edges(edges: DataFrame, dictionary: DataFrame, held: list[DataFrame] | None = None) -> DataFrame:
    """``edges`` with both ends as dictionary ids (``src, dst`` BIGINT). The second join
    reads the first one for hubs and for all others; with ``held`` (a registry of
    :func:`keep`) it is cached there, so that its edges are shuffled once."""
    senders = dictionary.where(F.col("out_degree") > 0).select(F.col("vertex").alias("src"), "out_degree", F.col("id").alias("from"))
    half = join_source(edges.select("src", "dst"), senders).select(F.col("dst").alias("src"), "from")
    if held is not None:
        half = keep(half, held)
    # the other end: the same join with the target as key, its in-edges as the count
    targets = dictionary.where(F.col("in_degree") > 0).select(F.col("vertex").alias("src"), F.col("in_degree").alias("out_degree"), F.col("id").alias("to"))
    return join_source(half, targets).select(F.col("from").alias("src"), F.col("to").alias("dst"))


def decode_vertices(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` (one per vertex, column ``vertex`` an id) with the original keys."""
    names = dictionary.select(F.col("id").alias("_id"), F.col("vertex").alias("_name"))
    joined = rows.join(names, F.col("vertex") == F.col("_id"))
    return joined.select(*[F.col("_name").alias("vertex") if c == "vertex" else F.col(c) for c in rows.columns])


def encode_vertices(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``rows`` (one per vertex) with ids for keys; unknown vertices drop out."""
    names = dictionary.select(F.col("id").alias("_id"), F.col("vertex").alias("_name"))
    joined = rows.join(names, F.col("vertex") == F.col("_name"))
    return joined.select(*[F.col("_id").alias("vertex") if c == "vertex" else F.col(c) for c in rows.columns])
