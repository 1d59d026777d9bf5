"""The driver loop: run a lazy step, cut its lineage, measure, decide.

Each iteration runs as the checkpoint of the new state. The L1 change and the
rank held by dangling vertices are collected while that job runs
(``DataFrame.observe``), so no extra pass over the state is needed; the
observed row count is checked against the state size, and a separate
aggregate is run if it ever disagrees. The driver only ever holds those
numbers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.sums import order_free_sum
from ..plans.lineage import cut_lineage


@dataclass
class RankResult:
    """Ranks (``vertex, rank``), iteration count and per-iteration history."""

    ranks: DataFrame
    iterations: int
    deltas: list[float] = field(default_factory=list)
    masses: list[float] = field(default_factory=list)
    # whether the tolerance was reached; None if none was given
    converged: bool | None = None

    def ordered(self) -> DataFrame:
        from .order import order_ranks

        return order_ranks(self.ranks)


def _measures(order_free: bool = False):
    add = order_free_sum if order_free else lambda value: F.sum(F.expr(value))
    return (
        F.coalesce(add("abs(rank - prev_rank)"), F.lit(0.0)).alias("delta"),
        F.coalesce(add("CASE WHEN is_dangling THEN rank END"), F.lit(0.0)).alias("dmass"),
        F.count(F.lit(1)).alias("rows"),
    )


def measure_state(state: DataFrame, order_free: bool = False, measures: tuple | None = None) -> tuple[float, float]:
    """(L1 change, rank held by dangling vertices) of a state, in one job."""
    row = state.agg(*(measures or _measures(order_free))).first()
    return float(row["delta"]), float(row["dmass"])


def checkpoint_and_measure(
    new: DataFrame, expected_rows: int | None, order_free: bool = False, measures: tuple | None = None
) -> tuple[DataFrame, float, float]:
    """Checkpoint a state and return it with its L1 change and dangling rank."""
    obs = Observation()
    state = cut_lineage(new.observe(obs, *(measures or _measures(order_free))))
    seen = obs.get
    if expected_rows is not None and seen.get("rows") == expected_rows:
        return state, float(seen["delta"]), float(seen["dmass"])
    delta, dmass = measure_state(state, order_free, measures)
    return state, delta, dmass


def iterate(
    state: DataFrame,
    step: Callable[[DataFrame, int, float], DataFrame],
    *,
    tol: float | None,
    max_iter: int | None,
    initial_dangling_rank: float,
    expected_rows: int | None = None,
    on_iteration: Callable[[int, DataFrame, float], None] | None = None,
    done: int = 0,
    order_free: bool = False,
    measures: tuple | None = None,
) -> tuple[DataFrame, int, list[float], list[float]]:
    """Repeat ``step`` until the L1 change is at most ``tol`` or ``max_iter``
    steps ran (whichever first); at least one step always runs.

    ``step(state, k, dangling_rank)`` builds iteration ``k`` lazily from the
    previous state and the rank its dangling vertices held. ``expected_rows``
    is the state size, used to validate the observed measures. ``done`` steps ran
    before (``state`` is theirs); they count for ``max_iter``. ``order_free`` measures
    with sums that do not depend on the partitions; ``measures`` are the aggregates for a
    state that is not one row per vertex. Returns the final state, the
    number of all steps, and the L1 change and dangling rank per step run here.
    """
    if tol is None and max_iter is None:
        raise ValueError("give tol, max_iter or both")
    deltas: list[float] = []
    masses: list[float] = []
    dangling_rank = initial_dangling_rank
    k = done
    while True:
        k += 1
        state, delta, dangling_rank = checkpoint_and_measure(step(state, k, dangling_rank), expected_rows, order_free, measures)
        deltas.append(delta)
        masses.append(dangling_rank)
        if on_iteration is not None:
            on_iteration(k, state, dangling_rank)
        if tol is not None and delta <= tol:
            break
        if max_iter is not None and k >= max_iter:
            break
    return state, k, deltas, masses
