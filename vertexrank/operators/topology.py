"""Graph topology from a clean edge table ``src, dst``.

Almost everything here derives from one aggregate, :func:`degree_table`: both
endpoints of every edge are emitted once, and a partial + final hash aggregate
gives out-degree, in-degree and self-loop count per vertex with a single
shuffle of pre-aggregated rows. A vertex with a third of all edges therefore
costs one row per map task in the shuffle, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_SIZE = 4096


def degree_table(edges: DataFrame) -> DataFrame:
    """``vertex, out_degree, in_degree, self_loops`` (BIGINT) for every vertex
    that is on an edge; a vertex exists only by being on an edge."""
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    as_src = edges.select(
        F.col("src").alias("vertex"),
        one.alias("o"),
        zero.alias("i"),
        F.when(F.col("src") == F.col("dst"), one).otherwise(zero).alias("s"),
    )
    as_dst = edges.select(F.col("dst").alias("vertex"), zero.alias("o"), one.alias("i"), zero.alias("s"))
    return as_src.unionByName(as_dst).groupBy("vertex").agg(
        F.sum("o").alias("out_degree"),
        F.sum("i").alias("in_degree"),
        F.sum("s").alias("self_loops"),
    )


def with_out_edges(edges: DataFrame) -> DataFrame:
    """Vertices with at least one out-edge."""
    return edges.select(F.col("src").alias("vertex")).distinct()


def with_in_edges(edges: DataFrame) -> DataFrame:
    """Vertices with at least one in-edge."""
    return edges.select(F.col("dst").alias("vertex")).distinct()


def vertices(edges: DataFrame) -> DataFrame:
    """Every vertex on an edge (union of both endpoint sets, distinct)."""
    return (
        edges.select(F.col("src").alias("vertex"))
        .unionByName(edges.select(F.col("dst").alias("vertex")))
        .distinct()
    )


def dangling(edges: DataFrame) -> DataFrame:
    """Vertices without an out-edge (vertices EXCEPT out-edge vertices)."""
    return degree_table(edges).where(F.col("out_degree") == 0).select("vertex")


def sources(edges: DataFrame) -> DataFrame:
    """Vertices without an in-edge (vertices EXCEPT in-edge vertices)."""
    return degree_table(edges).where(F.col("in_degree") == 0).select("vertex")


def close_dangling(edges: DataFrame) -> DataFrame:
    """Edges plus a self-loop ``v -> v`` for every dangling vertex, so no rank
    leaves the graph. Input self-loops already count as out-edges."""
    loops = dangling(edges).select(F.col("vertex").alias("src"), F.col("vertex").alias("dst"))
    return edges.select("src", "dst").unionByName(loops)


def out_degrees(edges: DataFrame) -> DataFrame:
    """``vertex, out_degree`` for vertices with an out-edge (partial aggregate)."""
    return edges.groupBy(F.col("src").alias("vertex")).agg(F.count(F.lit(1)).alias("out_degree"))


def adjacency(edges: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Neighbour lists ``vertex, chunk, out_degree, neighbours`` (sorted array).

    A vertex's list is cut into ``ceil(out_degree / chunk_size)`` chunks by a
    hash of the neighbour, so no row and no group holds more than about
    ``chunk_size`` neighbours, however large a hub is; the chunks of one hub
    land in different shuffle partitions. Every list is a set of rows ``chunk =
    0 .. n-1``, each sorted; one chunk is the common case of that, and readers
    that need one list per vertex flatten the chunks.
    """
    deg = out_degrees(edges).withColumnRenamed("vertex", "src")
    n_chunks = F.greatest(F.lit(1), F.ceil(F.col("out_degree") / F.lit(chunk_size))).cast("long")
    chunk = F.when(F.col("out_degree") <= chunk_size, F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64("dst"), n_chunks)
    )
    # The grouping key includes the chunk, so no aggregation group exceeds about
    # ``chunk_size`` rows.
    return (
        join_source(edges.select("src", "dst"), deg)
        .groupBy(F.col("src").alias("vertex"), chunk.alias("chunk"), "out_degree")
        .agg(F.array_sort(F.collect_list("dst")).alias("neighbours"))
    )


def compact_adjacency(edges: DataFrame, n_vertices: int, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Neighbour lists of dense ids (``src, dst`` in 0 .. n_vertices - 1) in few bytes:
    ``vertex, chunk, out_degree, n, base, width, packed``.

    A vertex's targets are cut by id range into about ``out_degree / chunk_size``
    chunks; a chunk is sorted, and each target stored as its difference from the
    smallest (``base``) in the fewest bytes (1, 2, 4 or 8) that hold the largest
    difference. The differences have one width, so a list is read in one pass
    (:func:`unpack_neighbours`) or at any place.
    """
    deg = out_degrees(edges).withColumnRenamed("vertex", "src")
    parts = F.ceil(F.col("out_degree") / F.lit(chunk_size)).cast("long")
    chunk = F.floor(F.col("dst") / F.lit(float(max(n_vertices, 1))) * parts).cast("long")
    lists = (
        join_source(edges.select("src", "dst"), deg)
        .groupBy(F.col("src").alias("vertex"), chunk.alias("chunk"), "out_degree")
        .agg(F.array_sort(F.collect_list("dst")).alias("_to"))
        .withColumn("base", F.element_at("_to", 1))
    )
    span = F.element_at("_to", -1) - F.col("base")
    width = F.when(span < 1 << 8, 1).when(span < 1 << 16, 2).when(span < 1 << 32, 4).otherwise(8)
    lists = lists.withColumn("width", width)
    digits = F.transform("_to", lambda to: F.lpad(F.hex(to - F.col("base")), 2 * F.col("width"), F.lit("0")))
    return lists.select("vertex", "chunk", "out_degree", F.size("_to").alias("n"), "base", "width", F.unhex(F.array_join(digits, "")).alias("packed"))


def unpack_neighbours(lists: DataFrame) -> DataFrame:
    """``vertex, chunk, out_degree, neighbours`` (sorted array) of :func:`compact_adjacency`."""
    start = lambda i: (i * F.col("width") + 1).cast("int")
    number = lambda i: F.conv(F.hex(F.substring("packed", start(i), F.col("width"))), 16, 10).cast("long")
    neighbours = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.col("base") + number(i))
    return lists.select("vertex", "chunk", "out_degree", neighbours.alias("neighbours"))


def join_source(edges: DataFrame, facts: DataFrame) -> DataFrame:
    """``edges`` with the facts of their source: ``facts`` has ``src``,
    ``out_degree`` (over these edges) and more, one row per source.

    Sources with more than an even share of a partition's edges are hubs: at
    most as many as there are partitions, whatever the graph, so their facts are
    broadcast and their edges stay spread where they are. All others meet in a
    shuffle, where none holds more than one partition's share. Lazy: the share
    is a scalar subquery.
    """
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = facts.agg((F.sum("out_degree") / F.lit(n)).alias("share")).scalar()
    hub = F.col("out_degree") > F.coalesce(share, F.lit(0.0))
    hubs = facts.where(hub)
    hot = edges.join(F.broadcast(hubs), "src")
    cold = edges.join(F.broadcast(hubs.select("src")), "src", "left_anti").join(facts.where(~hub), "src")
    return hot.unionByName(cold)


def graph_stats(edges: DataFrame) -> DataFrame:
    """One row: ``n_edges, n_vertices, n_dangling, n_sources, n_self_loops``."""
    return degree_table(edges).agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("long").alias("n_edges"),
        F.count(F.lit(1)).alias("n_vertices"),
        F.count_if(F.col("out_degree") == 0).alias("n_dangling"),
        F.count_if(F.col("in_degree") == 0).alias("n_sources"),
        F.coalesce(F.sum("self_loops"), F.lit(0)).cast("long").alias("n_self_loops"),
    )


def split_sources(edges: DataFrame) -> DataFrame:
    """Edges tagged by whether their source vertex has no in-edge:
    ``src, dst, from_source``. The untagged halves are the iterated adjacency
    and the adjacency of factored-out sources."""
    facts = degree_table(edges).where(F.col("out_degree") > 0)
    facts = facts.select(F.col("vertex").alias("src"), "out_degree", (F.col("in_degree") == 0).alias("from_source"))
    return join_source(edges.select("src", "dst"), facts).select("src", "dst", "from_source")


def source_inflow(edges: DataFrame) -> DataFrame:
    """``vertex, source_in``: for each vertex, the sum of ``1/out(u)`` over its
    in-edges from sources ``u``; vertices fed by no source are absent."""
    facts = degree_table(edges).where(F.col("out_degree") > 0)
    facts = facts.select(F.col("vertex").alias("src"), "out_degree", (F.col("in_degree") == 0).alias("from_source"))
    return (
        join_source(edges.select("src", "dst"), facts)
        .where("from_source")
        .groupBy(F.col("dst").alias("vertex"))
        .agg(F.sum(F.lit(1.0) / F.col("out_degree")).alias("source_in"))
    )
