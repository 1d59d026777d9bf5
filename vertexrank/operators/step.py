"""One rank iteration.

Two forms of the same recurrence ``r'(v) = (1-d) + d*m + d*sum_{u->v} r(u)/out(u)``:

* standalone operators over plain DataFrames (``contributions``, ``rank_step``,
  ``dangling_mass``, ``rank_delta``) for users composing their own plans;
* ``layout_step``, the fused step the loop runs on a :class:`GraphLayout`. It
  joins the co-partitioned cached edges with the state (no exchange), sums the
  shares with a partial + final aggregate (the one exchange), and left-joins the
  sums back onto the state (co-partitioned again). The old rank rides along
  as ``prev_rank`` so the change needs no extra join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sums import limbs_sql, total_sql
from ..plans.layout import STATE_COLUMNS, GraphLayout
from .topology import close_dangling, dangling, join_source, out_degrees

SELF_LOOP = "self_loop"
REDISTRIBUTE = "redistribute"
POLICIES = (SELF_LOOP, REDISTRIBUTE)


def _share(rank: str = "rank", degree: str = "out_degree"):
    """rank / out-degree; null for a vertex without out-edges (no division by 0)."""
    return F.when(F.col(degree) > 0, F.col(rank) / F.col(degree))


# ---------------------------------------------------------------- standalone


def contributions(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """``vertex, inflow``: sum of ``r(u)/out(u)`` over the in-edges of each
    vertex. ``edges`` are taken as given (close them first for the self-loop
    policy); vertices receiving nothing are absent."""
    deg = out_degrees(edges).withColumnRenamed("vertex", "src")
    facts = deg.join(ranks.select(F.col("vertex").alias("src"), F.col("rank")), "src")
    return (
        join_source(edges.select("src", "dst"), facts)
        .groupBy(F.col("dst").alias("vertex"))
        .agg(F.sum(_share()).alias("inflow"))
    )


def dangling_mass(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row ``dangling_mass``: rank held by dangling vertices divided by the
    vertex count (0 when there is no dangling vertex)."""
    d = dangling(edges).withColumn("_d", F.lit(True))
    return (
        ranks.join(d, "vertex", "left")
        .agg(
            (
                F.coalesce(F.sum(F.when(F.col("_d"), F.col("rank"))), F.lit(0.0))
                / F.count(F.lit(1))
            ).alias("dangling_mass")
        )
    )


def rank_step(
    edges: DataFrame,
    ranks: DataFrame,
    *,
    dangling: str = SELF_LOOP,
    damping: float = 0.85,
) -> DataFrame:
    """New ``vertex, rank`` from the ranks of every vertex.

    ``self_loop``: dangling vertices keep their rank via a self-loop.
    ``redistribute``: their rank is spread evenly over all vertices; the
    dangling mass enters the plan as a scalar subquery. The result is lazy.
    """
    if dangling not in POLICIES:
        raise ValueError(f"dangling must be one of {POLICIES}")
    base = 1.0 - damping
    graph = close_dangling(edges) if dangling == SELF_LOOP else edges
    inflow = contributions(graph, ranks)
    out = ranks.select("vertex", "rank").join(inflow, "vertex", "left")
    new = F.lit(base) + F.lit(damping) * F.coalesce(F.col("inflow"), F.lit(0.0))
    if dangling == REDISTRIBUTE:
        new = new + F.lit(damping) * F.coalesce(dangling_mass(edges, ranks).scalar(), F.lit(0.0))
    return out.select("vertex", new.alias("rank"))


def rank_delta(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``delta``: L1 distance between two rank vectors (matched on vertex)."""
    return (
        a.select("vertex", F.col("rank").alias("_a"))
        .join(b.select("vertex", F.col("rank").alias("_b")), "vertex")
        .agg(F.coalesce(F.sum(F.abs(F.col("_a") - F.col("_b"))), F.lit(0.0)).alias("delta"))
    )


# ---------------------------------------------------------------- fused loop step


def _double(x: float) -> str:
    """An exact DOUBLE literal for a SQL expression (a bare ``0.85`` would be
    parsed as DECIMAL)."""
    return f"double('{float(x)!r}')"


SHARE_EXPR = "CASE WHEN out_degree > 0 THEN rank / out_degree END"


def layout_step(
    layout: GraphLayout,
    state: DataFrame,
    *,
    self_loop: bool,
    damping: float,
    mass: float,
    source_rank: float | None,
    order_free: bool = False,
) -> DataFrame:
    """Next state from ``state`` over a laid-out graph (lazy, one exchange).

    ``mass`` is the dangling mass to add (0 for the self-loop policy);
    ``source_rank`` the rank the factored-out sources hold during this step
    (``None`` when sources are not factored out). ``order_free`` adds shares up as
    two integers each, so the sums do not depend on the partitions. Expressions are given as SQL
    strings (``selectExpr``): the loop builds a new plan every iteration, and
    one string per projection is far fewer driver round trips than a tree of
    column objects.
    """
    if order_free:
        parts_of = limbs_sql(SHARE_EXPR)
        share_columns = [f"{x} AS {name}" for x, name in zip(parts_of, ("share_hi", "share_lo"), strict=True)]
        inflow_sum = total_sql("sum(share_hi)", "sum(share_lo)")
    else:
        share_columns, inflow_sum = [f"{SHARE_EXPR} AS share"], "sum(share)"
    shares = state.selectExpr("vertex AS src", *share_columns)
    parts = []
    if layout.cold_edges is not None:
        parts.append(layout.cold_edges.join(shares.hint("merge"), "src"))
    if layout.hot_edges is not None:
        senders = shares if layout.strategy == "broadcast" else (
            state.where("is_hot").selectExpr("vertex AS src", *share_columns)
        )
        parts.append(layout.hot_edges.join(F.broadcast(senders), "src"))
    if parts:
        msgs = parts[0]
        for extra in parts[1:]:
            msgs = msgs.unionByName(extra)
        inflow = msgs.groupBy("dst").agg(F.expr(f"{inflow_sum} AS inflow")).withColumnRenamed("dst", "vertex")
        fed = state.join(inflow.hint("merge"), "vertex", "left")
        total = "coalesce(inflow, double('0.0'))"
    else:  # every edge left the loop with its source: nothing to join or shuffle
        fed, total = state, "double('0.0')"
    if self_loop:
        total += " + CASE WHEN is_dangling THEN rank ELSE double('0.0') END"
    if source_rank is not None:
        total += f" + source_in * {_double(source_rank)}"
    d = _double(damping)
    new_rank = f"{_double(1.0 - damping)} + {d} * {_double(mass)} + {d} * ({total})"
    return fed.selectExpr(
        *STATE_COLUMNS[:5], f"{new_rank} AS rank", "rank AS prev_rank"
    )
