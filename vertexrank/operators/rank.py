"""``rank``: the whole computation, composed from the layout, step and loop.

Recurrence (ranks start at ``initial_rank`` and are not normalised; with the
default 1.0 they sum to the vertex count under both dangling policies)::

    r'(v) = (1-d) + d * sum_{u->v} r(u)/out(u)              self_loop
    r'(v) = (1-d) + d * sum_{u->v} r(u)/out(u) + d * m      redistribute

``self_loop``: a dangling vertex (no out-edge) links to itself, so it keeps
its rank. ``redistribute``: it has no out-edge and ``m`` is the rank the
dangling vertices held in the previous iteration divided by the vertex count.

``prune_sources=True`` takes the vertices without in-edges out of the loop.
Their rank is known: ``initial_rank`` before the first step, then ``1-d``
(self-loop) or ``1-d + d*m`` (redistribute). Each vertex gets their share
through ``source_in`` = sum of ``1/out(u)`` over its in-edges from sources.
The self-loop form gives the same ranks as without pruning at every step.
The redistribute form uses the *current* ``m`` for the sources' share after
step one, so it reaches the same fixed point along a different path, and its
sources end at ``1-d + d*m`` with the ``m`` of the last step. In both pruned
forms the L1 change counts the iterated vertices only.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.layout import BROADCAST_MAX_VERTICES, GraphLayout, build_layout, choose_hubs
from ..plans.lineage import cut_lineage, keep, release
from ..plans.saved import SavedGraph
from ..session import list_folder, path_exists, sql_conf
from ..sources.edges import normalize_edges
from .dictionary import decode_vertices, encode_edges, encode_vertices, vertex_dictionary, vertex_numbers
from .loop import RankResult, iterate, measure_state
from .step import POLICIES, REDISTRIBUTE, layout_step

STRATEGIES = ("shuffle", "broadcast")
# A run that may take more steps than this is done on numbers instead of string keys:
# two joins of the edges once, against half of the task time of every step.
NUMBERED_STEPS = 20


def rank(
    edges: DataFrame | SavedGraph,
    *,
    dangling: str = "self_loop",
    prune_sources: bool = False,
    strategy: str = "shuffle",
    damping: float = 0.85,
    tol: float | None = None,
    max_iter: int | None = None,
    initial_rank: float = 1.0,
    num_partitions: int | None = None,
    hot_threshold: int | None = None,
    broadcast_max_vertices: int = BROADCAST_MAX_VERTICES,
    history_path: str | None = None,
    resume: bool = False,
    dense_ids: bool | None = None,
    order_free: bool = False,
    distinct: bool = False,
) -> RankResult:
    """Rank the vertices of ``edges`` (columns ``src, dst``, any one key type), or
    of a graph laid out on disk (``save_graph``, ``open_graph``), whose partitions
    and hubs are those it was saved with.

    Stops when the L1 change is at most ``tol`` or after ``max_iter`` steps,
    whichever comes first; ``tol`` alone runs to the tolerance, ``max_iter``
    alone exactly that many steps, and one of them must be given. At least one
    step always runs. ``RankResult.converged`` says whether the tolerance was
    reached (``None`` without one). Duplicate and null edges are dropped first;
    self-loops in the input count as out-edges.

    ``strategy="broadcast"`` joins the edges against a broadcast of the rank
    state instead of the co-partitioned one; it is used only while the vertex
    count is at most ``broadcast_max_vertices`` and gives the same values.
    ``history_path`` (a folder under a shared filesystem, not yet there)
    receives every iteration's ranks as parquet partitioned by ``iteration``, 0
    included.
    ``resume=True`` goes on from the last finished iteration in ``history_path``
    (none: from the start) and writes what follows there; ``iterations`` and
    ``max_iter`` count all steps, ``deltas`` has those run now. The settings must
    be those the history was written with; they are kept beside it and compared.
    ``dense_ids=True`` runs the loop on BIGINT ids from a dictionary of the keys,
    so a step shuffles eight bytes per id; results carry the keys. ``None`` (default) does
    so for string keys where more than ``NUMBERED_STEPS`` steps are possible and no history is
    written, with numbers that need no order (``vertex_numbers``), and large graphs without
    hubs (out-degrees above the hub threshold in force) step on blocks of vertices
    (``plans/blocks.py``); ``False`` never.
    ``order_free=True`` adds up in integers (``functions/sums.py``): ranks, changes
    and so the number of steps are the same to the last bit for any partitioning.
    ``num_partitions=None`` sizes the loop's partitions from the edge count; a given
    number is multiplied where its partitions would be large while task slots stay idle.
    ``distinct=True`` takes the edges as they are: the caller knows that none is null
    or repeated (``normalize_edges`` and the graphs of ``sources/graphs.py`` see to that),
    and the shuffle that would drop such edges is saved.
    """
    if dangling not in POLICIES:
        raise ValueError(f"dangling must be one of {POLICIES}")
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if tol is None and max_iter is None:
        raise ValueError("give tol, max_iter or both")
    if max_iter is not None and max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    saved = edges if isinstance(edges, SavedGraph) else None
    if saved is not None and (dense_ids or strategy != "shuffle"):
        raise ValueError("a saved graph runs as it was laid out: save encoded edges, use the shuffle strategy")
    if resume and history_path is None:
        raise ValueError("resume needs history_path")
    spark = saved.spark if saved is not None else edges.sparkSession
    redistribute = dangling == REDISTRIBUTE
    base = 1.0 - damping

    # Fixed partition count and no adaptive re-planning inside the loop: the
    # cached edges and the checkpointed state must keep the same hash layout,
    # which is what lets each step run with a single exchange. The layout sets
    # the partition count; both settings are restored on the way out.
    # The input plan (scans, joins, de-duplication) runs first, under the
    # session's own settings, so adaptive skew-join handling still applies to it.
    inputs: list[DataFrame] = []
    names: list[DataFrame] = []
    layout = None
    try:
        dictionary = clean = degrees = n_blocks = None
        if saved is None:
            clean = keep(edges.select("src", "dst") if distinct else normalize_edges(edges, sentinel=None), inputs)
            n_edges = clean.count()
            if dense_ids is None:
                many = max_iter is None or max_iter > NUMBERED_STEPS
                numbered = many and history_path is None and strategy == "shuffle" and dict(clean.dtypes)["src"] == "string"
            else:
                numbered = dense_ids
            if numbered:
                if dense_ids is None:
                    from ..plans import blocks  # numpy and pyarrow are needed for these runs only

                    session_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
                    n_blocks = blocks.choose_blocks(n_edges, num_partitions, session_partitions, spark.sparkContext.defaultParallelism)
                if n_blocks:
                    dictionary = blocks.block_numbers(clean, n_blocks)
                    if choose_hubs(dictionary, n_edges, n_blocks, hot_threshold)[1]:  # hubs are laid out on rows
                        n_blocks = None
                else:
                    dictionary = keep(vertex_dictionary(clean), names) if dense_ids else vertex_numbers(clean)
                degrees = dictionary.select(F.col("id").alias("vertex"), "out_degree", "in_degree")
                given, clean = clean, keep(encode_edges(clean, dictionary, inputs), inputs)
                clean.count()
                given.unpersist(blocking=False)
        shuffle_partitions = spark.conf.get("spark.sql.shuffle.partitions")
        loop_conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": shuffle_partitions}
        if n_blocks:
            loop_conf[blocks.ARROW_ROWS] = str(blocks.BATCH_ROWS)
        with sql_conf(spark, loop_conf):
            if n_blocks:
                layout = blocks.build_blocks(
                    clean, dictionary, n_blocks, prune_sources=prune_sources, initial_rank=initial_rank, order_free=order_free
                )
            elif saved is not None:
                layout = saved.layout(prune_sources=prune_sources, initial_rank=initial_rank)
            else:
                layout = build_layout(
                    clean,
                    n_edges=n_edges,
                    num_partitions=num_partitions,
                    prune_sources=prune_sources,
                    strategy=strategy,
                    initial_rank=initial_rank,
                    hot_threshold=hot_threshold,
                    broadcast_max_vertices=broadcast_max_vertices,
                    order_free=order_free,
                    degrees=degrees,
                )
            release(inputs)
            if not n_blocks and layout.is_empty:
                return RankResult(_empty_ranks(spark, saved.id_type if saved is not None else dict(edges.dtypes)["src"]), 0, [], [], None if tol is None else True)
            n_vertices = float(layout.n_vertices)
            masses: list[float] = []  # dangling mass m used by each step

            def mass_for(dangling_rank: float) -> float:
                return dangling_rank / n_vertices if redistribute else 0.0

            def source_rank_at(k: int, m: float) -> float:
                """Rank the factored-out sources hold after step k (k >= 1)."""
                return base + damping * m if redistribute else base

            def step(state: DataFrame, k: int, dangling_rank: float) -> DataFrame:
                m = mass_for(dangling_rank)
                masses.append(m)
                src_rank = None
                if prune_sources:
                    src_rank = initial_rank if k == 1 else source_rank_at(k, m)
                one_step = blocks.block_step if n_blocks else layout_step
                return one_step(
                    layout, state, self_loop=not redistribute, damping=damping, mass=m, source_rank=src_rank, order_free=order_free
                )

            def full_ranks(state: DataFrame, source_value: float | None) -> DataFrame:
                if n_blocks:
                    ranks = decode_vertices(blocks.block_ranks(layout, state), dictionary)
                    if layout.factored is not None:
                        ranks = ranks.unionByName(layout.factored.select("vertex", F.lit(float(source_value)).alias("rank")))
                    return ranks
                ranks = state.select("vertex", "rank")
                if layout.factored is not None:
                    ranks = ranks.unionByName(
                        layout.factored.select("vertex", F.lit(float(source_value)).alias("rank"))
                    )
                return ranks if dictionary is None else decode_vertices(ranks, dictionary)

            on_iteration, done = None, 0
            start, dangling_rank = layout.state, initial_rank * layout.n_dangling
            if history_path is not None:
                settings = dict(
                    dangling=dangling, prune_sources=prune_sources, damping=damping, initial_rank=initial_rank,
                    n_vertices=layout.n_vertices, n_edges=layout.n_edges,
                )
                done = _open_history(spark, history_path, settings, resume)
                if done is None:
                    _write_history(full_ranks(layout.state, initial_rank), 0, history_path)
                    done = 0

                def on_iteration(k: int, state: DataFrame, _dangling_rank: float) -> None:
                    _write_history(full_ranks(state, source_rank_at(k, masses[-1])), k, history_path)

            deltas: list[float] = []
            if done:
                start, mass = _state_after(spark, layout, history_path, done, dictionary, redistribute)
                delta, dangling_rank = measure_state(start, order_free)
                masses.append(mass)  # of the last step done
                if (tol is not None and delta <= tol) or (max_iter is not None and done >= max_iter):
                    final = full_ranks(start, source_rank_at(done, mass))
                    return RankResult(_kept(final, dictionary), done, deltas, [], None if tol is None else delta <= tol)
                masses.clear()
            state, k, deltas, _ = iterate(
                start,
                step,
                tol=tol,
                max_iter=max_iter,
                initial_dangling_rank=dangling_rank,
                expected_rows=layout.n_state,
                on_iteration=on_iteration,
                done=done,
                order_free=order_free,
                measures=blocks.block_measures(order_free) if n_blocks else None,
            )
            final = _kept(full_ranks(state, source_rank_at(k, masses[-1])), dictionary)
    finally:  # caches go whether the loop finished or failed
        release(inputs)
        release(names)
        if layout is not None:
            layout.close()
    return RankResult(final, k, deltas, masses, None if tol is None else deltas[-1] <= tol)


def _kept(ranks: DataFrame, dictionary: DataFrame | None) -> DataFrame:
    """Decoded ranks are written once, so the dictionary need not outlive the run."""
    return ranks if dictionary is None else cut_lineage(ranks)


def _write_history(ranks: DataFrame, k: int, path: str) -> None:
    # an iteration that an earlier run left unfinished is replaced
    ranks.select("vertex", "rank").write.mode("overwrite").parquet(f"{path.rstrip('/')}/iteration={k}")


def _open_history(spark: SparkSession, path: str, settings: dict, resume: bool) -> int | None:
    """The last iteration of which this one and all before are finished in
    ``path`` (none: ``None``); a new history gets its settings written."""
    path, beside = path.rstrip("/"), f"{path.rstrip('/')}/_settings"
    if not resume and path_exists(spark, path):
        raise FileExistsError(f"history_path is in use: {path}")
    there = {int(m[1]) for name in list_folder(spark, path) if (m := re.fullmatch(r"iteration=(\d+)", name))}
    there = {k for k in there if "_SUCCESS" in list_folder(spark, f"{path}/iteration={k}")}
    done = None
    while (0 if done is None else done + 1) in there:
        done = 0 if done is None else done + 1
    if "_SUCCESS" in list_folder(spark, beside):
        found = json.loads(spark.read.text(beside).first()["value"])
        if found != settings:
            raise ValueError(f"history_path was written with other settings: {found}")
    elif done is not None:
        raise ValueError(f"history_path has no settings: {path}")
    else:
        spark.range(1).select(F.lit(json.dumps(settings, sort_keys=True)).alias("value")).write.mode("overwrite").text(beside)
    return done


def _state_after(
    spark: SparkSession, layout: GraphLayout, path: str, k: int, dictionary: DataFrame | None, redistribute: bool
) -> tuple[DataFrame, float]:
    """The layout's state as it was after step ``k``, from the history, and the
    dangling mass that step used (read off the ranks before it)."""

    def ranks_at(i: int, name: str) -> DataFrame:
        rows = spark.read.parquet(f"{path.rstrip('/')}/iteration={i}").select("vertex", "rank")
        return (rows if dictionary is None else encode_vertices(rows, dictionary)).withColumnRenamed("rank", name)

    fixed = layout.state.drop("rank", "prev_rank")
    state = fixed.join(ranks_at(k, "rank").hint("merge"), "vertex").join(ranks_at(k - 1, "prev_rank").hint("merge"), "vertex")
    state = cut_lineage(state.select(*layout.state.columns))
    if state.count() != layout.n_state:
        raise ValueError(f"iteration {k} in {path} is of another graph")
    mass = 0.0
    if redistribute:
        held = state.where("is_dangling").agg(F.sum("prev_rank")).first()[0]
        mass = float(held or 0.0) / layout.n_vertices
    return state, mass


def _empty_ranks(spark: SparkSession, id_type: str) -> DataFrame:
    return spark.createDataFrame([], f"vertex {id_type}, rank double")
