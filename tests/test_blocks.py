"""Long runs over large graphs go on blocks of vertices; the rows are the same."""

import pytest

from vertexrank.operators import rank
from vertexrank.plans import blocks
from vertexrank.sources.graphs import order_chain

from .conftest import SF001, Approx, as_dict

FORMS = [dict(), dict(prune_sources=True), dict(dangling="redistribute"), dict(dangling="redistribute", prune_sources=True)]


@pytest.fixture
def steps(monkeypatch):
    """Steps that ran on blocks, with blocks also for small graphs."""
    seen, step = [], blocks.block_step
    monkeypatch.setattr(blocks, "MIN_EDGES", 0)
    monkeypatch.setattr(blocks, "block_step", lambda *a, **kw: seen.append(1) or step(*a, **kw))
    return seen


@pytest.fixture(scope="module")
def graph(spark):
    df = order_chain(spark, SF001).persist()
    yield df
    df.unpersist()


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("n", [1, 7])
def test_blocks_rank_as_rows_do(graph, steps, form, n):
    want = rank(graph, tol=0.1, distinct=True, dense_ids=False, **form)
    assert not steps
    got = rank(graph, tol=0.1, distinct=True, num_partitions=n, **form)
    assert len(steps) == got.iterations == want.iterations
    assert got.deltas == pytest.approx(want.deltas, abs=1e-9) and got.masses == pytest.approx(want.masses, abs=1e-9)
    assert Approx(as_dict(want.ranks), 1e-12) == as_dict(got.ranks)


@pytest.mark.parametrize("form", [dict(), dict(dangling="redistribute", prune_sources=True)])
def test_order_free_blocks_equal_rows_to_the_last_bit(graph, steps, form):
    rows = rank(graph, tol=0.5, order_free=True, num_partitions=8, hot_threshold=20, **form)
    assert not steps  # hubs are asked for
    runs = [rank(graph, tol=0.5, order_free=True, num_partitions=n, **form) for n in (2, 5)]
    assert len(steps) == 2 * rows.iterations
    assert len({(tuple(r.deltas), tuple(r.masses), frozenset(as_dict(r.ranks).items())) for r in (rows, *runs)}) == 1


@pytest.mark.parametrize("pairs", [[("a", "a")], [("a", "z")], [(None, "x"), ("a", "b"), ("a", "b"), ("b", "b")], [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")]])
@pytest.mark.parametrize("form", FORMS)
def test_small_graphs_on_blocks(edges, steps, pairs, form):
    e = edges(pairs)
    got = rank(e, tol=1e-3, num_partitions=4, **form)
    assert steps
    want = rank(e, tol=1e-3, dense_ids=False, **form)
    assert got.iterations == want.iterations and Approx(as_dict(want.ranks), 1e-12) == as_dict(got.ranks)


def test_far_targets_and_cut_tiles(spark, steps, monkeypatch):
    monkeypatch.setattr(blocks, "TILE_EDGES", 50)  # a target's edges lie in several tiles
    e = spark.range(3000).selectExpr("concat('v', id % 997) AS src", "concat('v', id * id % 1009) AS dst").distinct()
    e = e.union(spark.range(2).selectExpr("concat('w', id) AS src", "concat('v', id * 5) AS dst"))
    got = rank(e, tol=1e-3, prune_sources=True, num_partitions=3)
    want = rank(e, tol=1e-3, prune_sources=True, dense_ids=False)
    assert steps and got.iterations == want.iterations and Approx(as_dict(want.ranks), 1e-9) == as_dict(got.ranks)


def test_hubs_and_small_graphs_stay_on_rows(spark, edges, steps, monkeypatch):
    hub = spark.range(300).selectExpr("'hub' AS src", "concat('v', id) AS dst").union(spark.range(300).selectExpr("concat('v', id) AS src", "'hub' AS dst"))
    monkeypatch.setattr("vertexrank.plans.layout.MIN_HOT_THRESHOLD", 10)
    assert rank(hub, tol=1e-3, num_partitions=4).converged and not steps
    assert blocks.choose_blocks(10**12, None, 10**5, 12) is None and blocks.choose_blocks(270_000_000, None, 600, 12) == 12
    assert rank(edges([]), tol=1e-3).ranks.count() == 0
    monkeypatch.undo()
    assert blocks.choose_blocks(750_000, None, 600, 12) is None


def test_a_threshold_above_every_degree_leaves_no_hub(graph, steps, monkeypatch):
    # a threshold that would broadcast too many hubs is raised, here above every out-degree: nothing
    # is left to lay out as a hub, and the run need not go on rows for it
    monkeypatch.setattr("vertexrank.plans.layout.HOT_BROADCAST_MAX_ROWS", 5)
    with pytest.warns(UserWarning, match="would broadcast"):
        got = rank(graph, tol=0.5, order_free=True, num_partitions=3, hot_threshold=16)
    assert len(steps) == got.iterations
    want = rank(graph, tol=0.5, order_free=True, dense_ids=False)
    assert got.deltas == want.deltas and as_dict(got.ranks) == as_dict(want.ranks)


def test_each_partition_has_one_label(spark):
    for n in (1, 7, 64):
        labels = blocks.block_labels(spark, n)
        rows = spark.createDataFrame([(x,) for x in labels], "block long").repartition(n, "block").selectExpr("block", "spark_partition_id() AS p").collect()
        assert {r.block: r.p for r in rows} == {x: p for p, x in enumerate(labels)}
