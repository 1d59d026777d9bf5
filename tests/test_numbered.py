"""Runs of many steps over string keys go on numbers."""

import importlib

import pytest

from vertexrank.operators import encode_edges, rank
from vertexrank.operators.dictionary import vertex_numbers
from vertexrank.plans.inspect import shuffle_count
from vertexrank.session import sql_conf
from vertexrank.sources.graphs import order_chain

from .conftest import SF001, Approx, as_dict

rank_module = importlib.import_module("vertexrank.operators.rank")


@pytest.fixture
def key_types(monkeypatch):
    """Key type of the state of every step."""
    seen, step = [], rank_module.layout_step

    def spy(layout, state, **kw):
        seen.append(dict(state.dtypes)["vertex"])
        return step(layout, state, **kw)

    monkeypatch.setattr(rank_module, "layout_step", spy)
    return seen


@pytest.mark.parametrize("form", [dict(), dict(prune_sources=True), dict(dangling="redistribute", prune_sources=True, hot_threshold=16)])
def test_open_ended_runs_carry_numbers(spark, key_types, form):
    graph = order_chain(spark, SF001).persist()
    got = rank(graph, tol=0.5, distinct=True, **form)
    assert set(key_types) == {"bigint"} and dict(got.ranks.dtypes)["vertex"] == "string"
    key_types.clear()
    want = rank(graph, tol=0.5, distinct=True, dense_ids=False, **form)
    assert set(key_types) == {"string"} and got.iterations == want.iterations
    assert Approx(as_dict(want.ranks), 1e-9) == as_dict(got.ranks)
    graph.unpersist()


def test_short_runs_and_histories_keep_the_keys(edges, key_types, tmp_path):
    e = edges([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")])
    rank(e, max_iter=5)
    rank(e, tol=1e-3, history_path=str(tmp_path / "h"))
    assert set(key_types) == {"string"}
    assert rank(edges([]), tol=1e-3).ranks.dtypes == [("vertex", "string"), ("rank", "double")]


def test_numbers_are_distinct_and_small(spark):
    graph = order_chain(spark, SF001)
    rows = vertex_numbers(graph).collect()
    assert len({r.id for r in rows}) == len({r.vertex for r in rows}) == len(rows)
    assert 0 <= min(r.id for r in rows) and max(r.id for r in rows) < 100 * len(rows)


def test_edges_are_shuffled_once_per_end(spark):
    graph = order_chain(spark, SF001)
    names, held = vertex_numbers(graph), []
    with sql_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plain = encode_edges(graph, names)
        # the first join stands in the plan twice, once for the hubs of the second
        before, rows = shuffle_count(plain), sorted(plain.collect())
        kept = encode_edges(graph, names, held)
        assert shuffle_count(kept) < before
        assert sorted(kept.collect()) == rows
    held.pop().unpersist()
    assert not held
