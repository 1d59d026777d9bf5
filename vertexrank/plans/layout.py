"""Physical layout of a graph for the rank loop.

The loop runs one exchange per iteration. To get there, everything it joins is
laid out once, hash-partitioned on the vertex key into the same number of
partitions:

* ``cold_edges`` ``src, dst``: edges whose source is not a hub, hash-partitioned
  by ``src`` and cached. The state joins them without a shuffle.
* ``hot_edges`` ``src, dst``: edges of hub sources (out-degree above
  ``hot_threshold``), hash-partitioned by ``(src, dst)``, so a hub's edges
  are spread over every partition. They join a broadcast of the hubs' rank shares. The default threshold
  is at least ``ceil(n_edges / num_partitions)``, so there are at most
  ``num_partitions`` hubs; an explicit threshold is honoured while the counted
  hubs stay under ``HOT_BROADCAST_MAX_ROWS``. Either way the broadcast has a
  checked bound, and a source with a third of all edges becomes a hub whose
  edges stay spread over every task.
* ``state`` ``vertex, out_degree, is_dangling, is_hot, source_in, rank,
  prev_rank``: one row per iterated vertex, hash-partitioned by ``vertex`` and
  checkpointed.

With ``prune_sources`` the vertices without in-edges leave the state; their
edges are used once, for ``source_in`` (sum of ``1/out(u)`` over in-edges from
sources), and not scanned again.

With ``strategy="broadcast"`` every edge joins a broadcast of the whole state.
That is allowed only when the vertex count is at most ``broadcast_max_vertices``
(checked from an exact count); above it the layout falls back to the shuffle form.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sums import order_free_sum
from ..operators.topology import degree_table
from .lineage import cut_lineage, keep, release

MIN_HOT_THRESHOLD = 10_000
# Partition sizing when no count is given: no partition below MIN edges (task
# overhead dominates), none above MAX edges (memory and spill), otherwise one per
# task slot, at most the session's spark.sql.shuffle.partitions. A step shuffles one
# partial sum per partition and target it reaches: partitions beyond the slots only
# add partial sums, up to one per edge.
MIN_EDGES_PER_PARTITION = 10_000
MAX_EDGES_PER_PARTITION = 16_000_000
# A given partition count is multiplied where its partitions would hold more edges
# than this while task slots stay idle.
IDLE_EDGES_PER_PARTITION = 1_000_000
HOT_BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_VERTICES = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024

STATE_COLUMNS = ["vertex", "out_degree", "is_dangling", "is_hot", "source_in", "rank", "prev_rank"]


@dataclass
class GraphLayout:
    num_partitions: int
    strategy: str
    prune_sources: bool
    hot_threshold: int
    n_vertices: int
    n_edges: int
    n_dangling: int
    n_sources: int
    n_hot: int
    n_state: int
    cold_edges: DataFrame | None
    hot_edges: DataFrame | None
    state: DataFrame | None
    factored: DataFrame | None
    cached: list[DataFrame] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)  # declared over saved files

    @property
    def is_empty(self) -> bool:
        return self.n_vertices == 0

    def close(self) -> None:
        """Release the cached edge tables, and drop the tables declared over files."""
        spark = self.cached[0].sparkSession if self.cached else None
        release(self.cached)
        while self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")


def _count_stats(deg: DataFrame) -> dict[str, int]:
    row = deg.agg(
        F.count(F.lit(1)).alias("n_vertices"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("long").alias("n_edges"),
        F.count_if(F.col("out_degree") == 0).alias("n_dangling"),
        F.count_if(F.col("in_degree") == 0).alias("n_sources"),
        F.coalesce(F.sum(F.when(F.col("in_degree") > 0, F.col("out_degree"))), F.lit(0)).cast("long").alias("n_inner"),
        F.coalesce(F.avg(F.octet_length(F.col("vertex").cast("string"))), F.lit(0.0)).alias("id_bytes"),
    ).first()
    return row.asDict()


def choose_partitions(n_edges: int, session_partitions: int, slots: int | None = None) -> int:
    """Partition count for ``n_edges`` edges (see the MIN/MAX constants); ``slots`` is
    the number of tasks that run at a time."""
    small = max(1, math.ceil(n_edges / MIN_EDGES_PER_PARTITION))
    large = math.ceil(n_edges / MAX_EDGES_PER_PARTITION)
    most = session_partitions if slots is None else min(session_partitions, slots)
    return max(1, min(most, small), large)


def spread_partitions(n_edges: int, num_partitions: int, slots: int) -> int:
    """``num_partitions``, or the smallest multiple of it that keeps the task slots busy
    with large partitions and no partition above ``MAX_EDGES_PER_PARTITION``."""
    busy = min(slots, math.ceil(n_edges / IDLE_EDGES_PER_PARTITION))
    least = max(busy, math.ceil(n_edges / MAX_EDGES_PER_PARTITION))
    return num_partitions * max(1, math.ceil(least / num_partitions))


def choose_hubs(degrees: DataFrame, n_edges: int, n: int, hot_threshold: int | None) -> tuple[int, int]:
    """(out-degree above which a source is a hub, number of hubs) over ``n`` partitions:
    the given threshold, raised where it would broadcast too many hubs."""
    if hot_threshold is None:
        # at most num_partitions sources can exceed ceil(n_edges / num_partitions)
        threshold = max(MIN_HOT_THRESHOLD, math.ceil(n_edges / n))
    else:
        threshold = max(1, int(hot_threshold))
    n_hot = degrees.where(F.col("out_degree") > threshold).count()
    if n_hot > HOT_BROADCAST_MAX_ROWS:  # keep the broadcast of hub shares bounded
        threshold = max(threshold, math.ceil(n_edges / HOT_BROADCAST_MAX_ROWS))
        warnings.warn(f"hot_threshold={hot_threshold} would broadcast {n_hot} hubs; raised to {threshold}", stacklevel=4)
        n_hot = degrees.where(F.col("out_degree") > threshold).count()
    return threshold, n_hot


def build_layout(
    edges: DataFrame,
    *,
    num_partitions: int | None = None,
    n_edges: int | None = None,
    prune_sources: bool = False,
    strategy: str = "shuffle",
    initial_rank: float = 1.0,
    hot_threshold: int | None = None,
    broadcast_max_vertices: int = BROADCAST_MAX_VERTICES,
    order_free: bool = False,
    degrees: DataFrame | None = None,
) -> GraphLayout:
    """Lay out a clean, distinct edge table for the loop. ``degrees``
    (``vertex, out_degree, in_degree``) saves counting them where the caller has them.

    Must run inside a settings scope with adaptive execution off (``rank``
    does this): it sets ``spark.sql.shuffle.partitions`` to the partition
    count, so that every aggregate's output partitioning equals the explicit
    ``repartition`` of the edges. ``num_partitions=None`` sizes it from the
    edge count (:func:`choose_partitions`); a given count is multiplied on graphs
    too large for it (:func:`spread_partitions`).
    """
    spark = edges.sparkSession
    build: list[DataFrame] = []  # caches needed only while building
    # The clean edges are cached once (unless the caller already did): the
    # degree table, the hub split and the repartition by source all read them,
    # so the input is scanned and de-duplicated a single time.
    owner = edges if edges.is_cached else keep(edges, build)
    clean = owner.select("src", "dst")
    sized = num_partitions is None
    slots = spark.sparkContext.defaultParallelism
    if n_edges is None:
        n_edges = clean.count()
    if sized:
        session_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        num_partitions = choose_partitions(n_edges, session_partitions, slots)
    n = num_partitions if sized else spread_partitions(n_edges, num_partitions, slots)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    # Explicit layout, not inherited: the state that grows out of this table
    # must be hash-partitioned by vertex into exactly n partitions whatever the
    # input looks like (a one-partition input would otherwise leave it in one).
    # One shuffle of one row per vertex, at build time only.
    deg = keep((degree_table(clean) if degrees is None else degrees).repartition(n, "vertex"), build)
    stats = _count_stats(deg)
    n_vertices, n_edges = stats["n_vertices"], stats["n_edges"]
    n_sources = stats["n_sources"]
    n_state = n_vertices - n_sources if prune_sources else n_vertices
    if sized and prune_sources and n_vertices:
        # the loop runs on the edges of the vertices that stay
        inner = choose_partitions(max(stats["n_inner"], n_state), session_partitions, slots)
        if inner != n:
            n = inner
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            deg = keep(deg.repartition(n, "vertex"), build)
    if n_vertices == 0:
        release(build)
        return GraphLayout(n, strategy, prune_sources, 0, 0, 0, 0, 0, 0, 0, None, None, None, None)

    # a broadcast row holds the id, its share and the hash map's overhead
    state_bytes = int(n_vertices * (stats["id_bytes"] + 48))
    if strategy == "broadcast" and (n_vertices > broadcast_max_vertices or state_bytes > BROADCAST_MAX_BYTES):
        warnings.warn(
            f"{n_vertices} vertices (about {state_bytes} bytes) exceed broadcast_max_vertices="
            f"{broadcast_max_vertices} or {BROADCAST_MAX_BYTES} bytes; using the shuffle layout",
            stacklevel=3,
        )
        strategy = "shuffle"

    if strategy == "broadcast":
        threshold = 0  # every source counts as a hub: all edges join the broadcast state
        n_hot = n_vertices - stats["n_dangling"]
    else:
        threshold, n_hot = choose_hubs(deg, n_edges, n, hot_threshold)

    # Per-source facts: out-degree and whether the source has no in-edge.
    src_facts = deg.select(
        F.col("vertex").alias("src"),
        F.col("out_degree").alias("src_out"),
        (F.col("in_degree") == 0).alias("from_source"),
    )
    # bounded: n_hot <= num_partitions by default, <= HOT_BROADCAST_MAX_ROWS
    # always, or <= broadcast_max_vertices for the broadcast strategy
    hubs = src_facts.where(F.col("src_out") > threshold)

    cached: list[DataFrame] = []  # caches the loop reads
    source_parts: list[DataFrame] = []

    def source_messages(df: DataFrame) -> DataFrame:
        return df.where(F.col("from_source")).select(
            F.col("dst").alias("vertex"), (F.lit(1.0) / F.col("src_out")).alias("w")
        )

    hot_edges = None
    if n_hot > 0:
        hot_all = clean.join(F.broadcast(hubs), "src")
        hot = hot_all.where(~F.col("from_source")) if prune_sources else hot_all
        # spread over all n partitions by (src, dst): a hub's edges land everywhere
        hot_edges = keep(hot.select("src", "dst").repartition(n, "src", "dst"), cached)
        if hot_edges.count() == 0:
            hot_edges = None
        if prune_sources:
            source_parts.append(source_messages(hot_all))

    cold_edges = None
    if strategy == "shuffle":
        cold = clean
        if n_hot > 0:
            cold = clean.join(F.broadcast(hubs.select("src")), "src", "left_anti")
        cold = cold.repartition(n, "src")
        if prune_sources:
            # co-partitioned with deg (both hash(src/vertex, n)): no second exchange
            cold_all = keep(cold.join(src_facts, "src"), build)
            cold_all.count()
            if owner in build:  # peak stays at two copies of the edges
                owner.unpersist(blocking=False)
            source_parts.append(source_messages(cold_all))
            cold = cold_all.where(~F.col("from_source"))
        # sorted once, so that the merge join of every step sorts only the state
        cold_edges = keep(cold.select("src", "dst").sortWithinPartitions("src"), cached)

    source_in = None
    if source_parts:
        msgs = source_parts[0]
        for part in source_parts[1:]:
            msgs = msgs.unionByName(part)
        source_in = msgs.groupBy("vertex").agg((order_free_sum("w") if order_free else F.sum("w")).alias("source_in"))

    base = deg.where(F.col("in_degree") > 0) if prune_sources else deg
    base = base.select(
        "vertex",
        "out_degree",
        (F.col("out_degree") == 0).alias("is_dangling"),
        (F.col("out_degree") > threshold).alias("is_hot"),
    )
    if source_in is not None:
        base = base.join(source_in.hint("merge"), "vertex", "left").withColumn(
            "source_in", F.coalesce(F.col("source_in"), F.lit(0.0))
        )
    else:
        base = base.withColumn("source_in", F.lit(0.0))
    r0 = F.lit(float(initial_rank))
    state = cut_lineage(base.select(*STATE_COLUMNS[:5], r0.alias("rank"), r0.alias("prev_rank")))

    factored = None
    if prune_sources:
        factored = cut_lineage(deg.where(F.col("in_degree") == 0).select("vertex"))

    if cold_edges is not None and cold_edges.count() == 0:
        cold_edges = None
    release(build)

    layout = GraphLayout(
        num_partitions=n,
        strategy=strategy,
        prune_sources=prune_sources,
        hot_threshold=threshold,
        n_vertices=n_vertices,
        n_edges=n_edges,
        n_dangling=stats["n_dangling"],
        n_sources=n_sources,
        n_hot=n_hot,
        n_state=n_state,
        cold_edges=cold_edges,
        hot_edges=hot_edges,
        state=state,
        factored=factored,
        cached=cached,
    )
    return layout
