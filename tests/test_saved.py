"""Graphs laid out on disk, dense ids, resumed runs and order-free sums."""

import math
import random

import pytest
from pyspark.sql import functions as F

from vertexrank.functions.sums import order_free_sum
from vertexrank.operators import (
    compact_adjacency,
    decode_vertices,
    encode_edges,
    rank,
    unpack_neighbours,
    vertex_dictionary,
)
from vertexrank.operators.step import layout_step
from vertexrank.plans.inspect import live_plan_lines, plan_text, python_nodes, shuffle_count
from vertexrank.plans.saved import open_graph, save_graph
from vertexrank.session import sql_conf
from vertexrank.sources.graphs import order_chain
from vertexrank.sources.sinks import read_rank_history

from .conftest import SF001, Approx, as_dict

FORMS = [
    dict(),
    dict(prune_sources=True),
    dict(dangling="redistribute"),
    dict(dangling="redistribute", prune_sources=True),
]


@pytest.fixture(scope="module")
def graph(spark):
    df = order_chain(spark, SF001).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def expected(graph):
    return [as_dict(rank(graph, max_iter=4, **form).ranks) for form in FORMS]


@pytest.fixture(scope="module")
def saved(spark, graph, tmp_path_factory):
    return save_graph(graph, str(tmp_path_factory.mktemp("graph") / "g"), num_partitions=4, hot_threshold=30)


@pytest.mark.parametrize("i", range(4))
def test_saved_graph_ranks_as_its_edges(spark, saved, expected, i):
    before = {t.name for t in spark.catalog.listTables()}
    again = open_graph(spark, saved.path + "/")
    assert again.num_partitions == 4 and 0 < again.n_hot < again.n_vertices
    for run in (saved, again):
        assert Approx(expected[i], 1e-9) == as_dict(rank(run, max_iter=4, **FORMS[i]).ranks)
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("prune", [False, True])
def test_saved_graph_needs_no_exchange_of_edges(spark, saved, prune):
    with sql_conf(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "9"}):
        layout = saved.layout(prune_sources=prune)
        step = layout_step(layout, layout.state, self_loop=True, damping=0.85, mass=0.0, source_rank=1.0 if prune else None)
        assert shuffle_count(step) == 1 and not python_nodes(step), plan_text(step)
        whole = plan_text(layout.cold_edges)
        assert "Bucketed: true" in whole and "Exchange" not in whole and "Sort " not in whole
        # the merge join reads the edges as they are: what is sorted is the state
        joins = [x for x in live_plan_lines(step) if "Sort [src" in x]
        assert len(joins) <= 1
        layout.close()


def test_saved_hubs_are_bounded(graph, expected, tmp_path, monkeypatch):
    # every source above a given threshold was a hub, and every step broadcasts the hubs
    monkeypatch.setattr("vertexrank.plans.layout.HOT_BROADCAST_MAX_ROWS", 20)
    with pytest.warns(UserWarning, match="would broadcast"):
        few = save_graph(graph, str(tmp_path / "g"), num_partitions=4, hot_threshold=1)
    assert few.n_hot <= 20 and few.hot_threshold > 1
    assert Approx(expected[3], 1e-9) == as_dict(rank(few, max_iter=4, **FORMS[3]).ranks)


def test_save_refuses_a_folder_in_use_and_open_an_unfinished_one(spark, saved, edges, tmp_path):
    with pytest.raises(FileExistsError):
        save_graph(edges([("a", "b")]), saved.path)
    edges([("a", "b")]).write.parquet(str(tmp_path / "half" / "edges"))
    with pytest.raises(FileNotFoundError):
        open_graph(spark, str(tmp_path / "half"))
    with pytest.raises(ValueError):
        rank(saved, max_iter=1, dense_ids=True)


@pytest.mark.parametrize("pairs", [[], [("a", "a")], [("a", "z")], [(None, "x"), ("a", "b"), ("a", "b")]])
def test_small_graphs_in_every_new_form(spark, edges, tmp_path, pairs):
    e = edges(pairs)
    saved = save_graph(e, str(tmp_path / "g"))
    for form in FORMS:
        want = as_dict(rank(e, max_iter=3, **form).ranks)
        for got in (rank(saved, max_iter=3, **form), rank(e, max_iter=3, dense_ids=True, **form), rank(e, max_iter=3, order_free=True, **form)):
            assert Approx(want, 1e-12) == as_dict(got.ranks) and got.ranks.dtypes[0] == ("vertex", "string")


def test_dictionary_is_dense_and_ordered(spark, graph):
    names = vertex_dictionary(graph, num_partitions=5).collect()
    assert sorted((r.vertex, r.id) for r in names) == [(v, i) for i, v in enumerate(sorted(r.vertex for r in names))]
    dictionary = vertex_dictionary(graph)
    coded = encode_edges(graph, dictionary)
    assert coded.dtypes == [("src", "bigint"), ("dst", "bigint")]
    name = {r.id: r.vertex for r in dictionary.collect()}
    assert {(name[r.src], name[r.dst]) for r in coded.collect()} == {(r.src, r.dst) for r in graph.collect()}
    back = decode_vertices(dictionary.select(F.col("id").alias("vertex"), (F.col("id") * 2).alias("x")), dictionary)
    assert {r.vertex: r.x for r in back.collect()} == {v: 2 * i for i, v in name.items()}


def test_dictionary_with_a_hub_on_either_end(spark, edges):
    e = edges([("hub", f"v{i}") for i in range(500)] + [(f"v{i}", "sink") for i in range(500)])
    dictionary = vertex_dictionary(e)
    assert encode_edges(e, dictionary).distinct().count() == 1000
    assert "BroadcastHashJoin" in plan_text(encode_edges(e, dictionary))


@pytest.mark.parametrize("i", range(4))
def test_dense_ids_give_the_same_ranks(graph, expected, i):
    for extra in (dict(), dict(hot_threshold=30), dict(strategy="broadcast")):
        assert Approx(expected[i], 1e-9) == as_dict(rank(graph, max_iter=4, dense_ids=True, **FORMS[i], **extra).ranks)


def test_compact_lists_round_trip(spark):
    rng = random.Random(3)
    n = 1 << 33
    pairs = {(v, rng.choice([rng.randrange(n), rng.randrange(300), n - 1])) for v in range(20) for _ in range(rng.randrange(1, 60))}
    pairs |= {(99, t) for t in range(0, 5000, 2)}  # close neighbours of a large vertex
    e = spark.createDataFrame(sorted(pairs), "src long, dst long")
    for size in (7, 4096):
        lists = compact_adjacency(e, n, chunk_size=size)
        rows = unpack_neighbours(lists).collect()
        assert all(r.neighbours == sorted(r.neighbours) for r in rows)
        assert sorted((r.vertex, t) for r in rows for t in r.neighbours) == sorted(pairs)
    packed = {r.vertex: (r.width, len(r.packed)) for r in lists.where("vertex = 99").collect()}
    assert packed == {99: (2, 5000)}  # two bytes a neighbour, plain ones take eight
    assert unpack_neighbours(compact_adjacency(e.limit(0), n)).count() == 0


@pytest.mark.parametrize("form", [dict(), dict(dangling="redistribute", prune_sources=True)])
@pytest.mark.parametrize("dense", [False, True])
def test_resume_goes_on_where_the_history_ends(spark, graph, tmp_path, form, dense):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    whole = rank(graph, max_iter=6, history_path=one, dense_ids=dense, **form)
    rank(graph, max_iter=3, history_path=two, dense_ids=dense, **form)
    # an iteration that was being written when the run was lost has no end mark
    spark.range(3).selectExpr("'lost' AS vertex", "0.5D AS rank").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{two}/iteration=4")
    rest = rank(graph, max_iter=6, history_path=two, resume=True, dense_ids=dense, **form)
    assert rest.iterations == 6 and len(rest.deltas) == 3
    assert rest.deltas == pytest.approx(whole.deltas[3:], abs=1e-9)
    assert Approx(as_dict(whole.ranks), 1e-9) == as_dict(rest.ranks)
    read = lambda p: {(r.iteration, r.vertex): r.rank for r in read_rank_history(spark, p).collect()}
    assert Approx(read(one), 1e-9) == read(two)
    again = rank(graph, max_iter=6, history_path=two, resume=True, dense_ids=dense, **form)  # nothing is left to do
    assert again.iterations == 6 and not again.deltas and Approx(as_dict(whole.ranks), 1e-9) == as_dict(again.ranks)


def test_resume_stops_by_tolerance_as_one_run_does(graph, tmp_path):
    path = str(tmp_path / "h")
    whole = rank(graph, dangling="redistribute", tol=1e-2)
    rank(graph, dangling="redistribute", max_iter=whole.iterations - 2, history_path=path)
    rest = rank(graph, dangling="redistribute", tol=1e-2, history_path=path, resume=True)
    assert rest.converged and rest.iterations == whole.iterations and len(rest.deltas) == 2
    done = rank(graph, dangling="redistribute", tol=1e-2, history_path=path, resume=True)
    assert done.converged and done.iterations == whole.iterations and done.deltas == []


def test_resume_refuses_other_settings(graph, edges, tmp_path):
    path = str(tmp_path / "h")
    rank(graph, max_iter=2, history_path=path)
    for other in (dict(damping=0.5), dict(dangling="redistribute"), dict(prune_sources=True)):
        with pytest.raises(ValueError, match="other settings"):
            rank(graph, max_iter=3, history_path=path, resume=True, **other)
    with pytest.raises(ValueError, match="other settings"):
        rank(edges([("a", "b")]), max_iter=3, history_path=path, resume=True)
    with pytest.raises(ValueError, match="needs history_path"):
        rank(graph, max_iter=3, resume=True)
    fresh = rank(graph, max_iter=2, history_path=str(tmp_path / "new"), resume=True)  # nothing there yet
    assert fresh.iterations == 2


def test_resume_of_a_saved_graph(saved, expected, tmp_path):
    path = str(tmp_path / "h")
    rank(saved, max_iter=2, history_path=path, **FORMS[3])
    assert Approx(expected[3], 1e-9) == as_dict(rank(saved, max_iter=4, history_path=path, resume=True, **FORMS[3]).ranks)


def test_order_free_sum_has_one_value_for_any_order(spark):
    rng = random.Random(7)
    values = [rng.uniform(0, 1) * 10 ** rng.randrange(-8, 8) for _ in range(4000)] + [None]
    sums = set()
    for seed, parts in ((1, 1), (2, 3), (3, 40)):
        mixed = random.Random(seed).sample(values, len(values))
        sums.add(spark.createDataFrame([(x,) for x in mixed], "x double").repartition(parts).agg(order_free_sum("x")).first()[0])
    assert len(sums) == 1 and sums.pop() == pytest.approx(math.fsum(x for x in values if x is not None), rel=1e-13)
    assert spark.createDataFrame([(None,)], "x double").agg(order_free_sum("x")).first()[0] is None


@pytest.mark.parametrize("form", FORMS)
def test_order_free_ranks_do_not_depend_on_the_layout(graph, form):
    runs = [rank(graph, tol=0.5, order_free=True, num_partitions=n, hot_threshold=h, **form) for n, h in ((3, None), (8, 20), (64, None))]
    assert len({(r.iterations, tuple(r.deltas), tuple(r.masses)) for r in runs}) == 1
    assert len({frozenset(as_dict(r.ranks).items()) for r in runs}) == 1  # to the last bit
    plain = rank(graph, tol=0.5, **form)
    assert plain.iterations == runs[0].iterations and Approx(as_dict(plain.ranks), 1e-9) == as_dict(runs[0].ranks)
