"""Plan shape: one shuffle per step, constant plan size, no Python, pushdown."""

import pytest
from pyspark.sql import functions as F

import vertexrank.operators as ops
from vertexrank.operators import degree_table, rank
from vertexrank.operators.step import layout_step
from vertexrank.plans.inspect import live_plan_lines, plan_text, python_nodes, shuffle_count
from vertexrank.plans.layout import build_layout, choose_partitions, spread_partitions
from vertexrank.session import sql_conf
from vertexrank.sources.edges import normalize_edges
from vertexrank.sources.graphs import customer_supplier, order_chain, returned_part_chain

from .conftest import SF001

LOOP_CONF = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "4"}


@pytest.mark.parametrize(
    "kw",
    [
        dict(),
        dict(prune_sources=True),
        dict(hot_threshold=3),
        dict(hot_threshold=3, prune_sources=True),
        dict(strategy="broadcast"),
    ],
)
def test_one_shuffle_per_step_and_constant_plan(spark, kw):
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(returned_part_chain(spark, SF001), num_partitions=4, **kw)
        state = layout.state
        sizes = []
        for k in range(3):
            step = layout_step(
                layout, state, self_loop=True, damping=0.85, mass=0.0,
                source_rank=1.0 if kw.get("prune_sources") else None,
            )
            assert shuffle_count(step) == 1, plan_text(step)
            assert not python_nodes(step)
            sizes.append(len(live_plan_lines(step)))
            state = step.checkpoint(eager=True)
        assert sizes[1] == sizes[2] <= sizes[0]  # the first state is not sorted yet
        layout.close()


def test_hub_edges_use_bounded_broadcast(spark):
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(returned_part_chain(spark, SF001), num_partitions=4, hot_threshold=3)
        assert 0 < layout.n_hot <= layout.n_vertices
        step = layout_step(layout, layout.state, self_loop=True, damping=0.85, mass=0.0, source_rank=None)
        text = "\n".join(live_plan_lines(step))
        assert "BroadcastExchange" in text and "SortMergeJoin" in text
        layout.close()


def test_default_hub_threshold_bounds_hub_count(spark):
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(customer_supplier(spark, SF001), num_partitions=4)
        assert layout.hot_threshold >= layout.n_edges / 4
        assert layout.n_hot <= 4
        layout.close()


def test_graph_scan_prunes_and_pushes_down(spark):
    text = plan_text(customer_supplier(spark, SF001))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text
    schemas = [s.splitlines()[0] for s in text.split("ReadSchema: ")[1:]]
    assert sorted(s.count(":") for s in schemas) == [2, 2]  # the keys only


def test_python_nodes_sees_arrow_maps(spark):
    df = spark.range(4).mapInArrow(lambda it: it, "id long")
    assert python_nodes(df) and not python_nodes(spark.range(4))


@pytest.mark.parametrize("name", ["adjacency", "split_sources", "source_inflow", "contributions", "rank_step"])
def test_hot_source_is_joined_by_a_bounded_broadcast(spark, name):
    """One source with 60 % of the edges: its facts are broadcast, its edges stay."""
    hot = spark.range(6000).selectExpr("0L AS src", "id + 1 AS dst")
    cold = spark.range(4000).selectExpr("id % 900 + 1 AS src", "id * 7 % 5000 + 1 AS dst")
    e = hot.union(cold).distinct()
    ranks = ops.vertices(e).selectExpr("vertex", "1.0D AS rank")
    args = (e, ranks) if name in ("contributions", "rank_step") else (e,)
    df = getattr(ops, name)(*args)
    text = plan_text(df)
    assert "BroadcastHashJoin" in text and "Subquery" in text
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    deg = ops.out_degrees(e)
    assert deg.where(f"out_degree > {e.count()} / {n}").count() <= n
    df.collect()


def test_pruned_graph_without_inner_edges_runs_without_shuffle(spark):
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(customer_supplier(spark, SF001), num_partitions=4, prune_sources=True)
        assert layout.cold_edges is None and layout.hot_edges is None
        step = layout_step(layout, layout.state, self_loop=True, damping=0.85, mass=0.0, source_rank=0.15)
        assert shuffle_count(step) == 0
        layout.close()


def test_hub_and_cold_edges_both_in_the_pruned_loop(spark):
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(order_chain(spark, SF001), num_partitions=4, prune_sources=True, hot_threshold=16)
        assert layout.hot_edges.count() > 0 and layout.cold_edges.count() > 0
        layout.close()


def test_build_layout_leaves_the_callers_cache(spark):
    e = customer_supplier(spark, SF001).persist()
    e.count()
    with sql_conf(spark, LOOP_CONF):
        build_layout(e, num_partitions=4, prune_sources=True).close()
    assert e.is_cached and e.storageLevel.useMemory
    e.unpersist()


def test_degree_table_is_one_partial_aggregate(spark):
    e = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    deg = degree_table(e)
    assert shuffle_count(deg) == 1
    assert "partial_sum" in plan_text(deg)


def test_rank_restores_session_settings(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    rank(spark.createDataFrame([("a", "b")], "src string, dst string"), max_iter=1)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"


def test_partitions_follow_the_task_slots(spark):
    # a step shuffles one partial sum per partition and target: more partitions than
    # slots made that figure grow faster than the edges
    assert choose_partitions(45_000_000, 100, 12) == choose_partitions(4_500_000, 12, 12) == 12
    assert choose_partitions(270_000_000, 600, 12) == 17 and choose_partitions(10**12, 600, 12) == 62_500
    assert choose_partitions(25_000, 100, 12) == 3 and choose_partitions(0, 100, 12) == 1
    rows = spark.range(200_000).select((F.col("id") % 500).alias("src"), (F.col("id") * 7919 % 200_003).alias("dst"))
    with sql_conf(spark, LOOP_CONF | {"spark.sql.shuffle.partitions": "64"}):
        layout = build_layout(rows.cache(), n_edges=200_000)
        assert layout.num_partitions == spark.sparkContext.defaultParallelism
        layout.close()
    rows.unpersist()


def test_distinct_edges_are_not_shuffled_to_be_cleaned(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    assert shuffle_count(normalize_edges(e, sentinel=None)) == 1
    taken = rank(e, max_iter=3, distinct=True).ranks
    assert sorted(taken.collect()) == sorted(rank(e, max_iter=3).ranks.collect())


def test_given_partitions_are_multiplied_on_large_graphs(spark):
    # three partitions used to leave all but three task slots idle, whatever the graph
    assert [spread_partitions(n, 3, 12) for n in (0, 3_000_000, 4_500_000, 45_000_000, 270_000_000)] == [3, 3, 6, 12, 18]
    assert spread_partitions(45_000_000, 11, 12) == 22 and spread_partitions(10_000_000, 11, 12) == 11
    with sql_conf(spark, LOOP_CONF):
        layout = build_layout(customer_supplier(spark, SF001), num_partitions=3)
        assert layout.num_partitions == 3
        layout.close()
