"""Hand-computed small graphs (T1-T8) and invariants of the rank loop."""

import pytest
from pyspark.sql import functions as F

from vertexrank.operators import (
    contributions,
    close_dangling,
    dangling_mass,
    rank,
    rank_delta,
    rank_step,
)
from vertexrank.sources.graphs import returned_part_chain

from .conftest import SF001, Approx, as_dict

T1 = [("a", "z")]
T2 = [("1", "2"), ("1", "3"), ("2", "3"), ("4", "1")]
T3 = [("a", "b"), ("b", "c"), ("c", "a")]
T4 = [("a", "a"), ("a", "b")]
FORMS = [
    dict(dangling="self_loop"),
    dict(dangling="self_loop", prune_sources=True),
    dict(dangling="redistribute"),
    dict(dangling="redistribute", prune_sources=True),
]


def ranks(e, **kw):
    res = rank(e, **kw)
    return as_dict(res.ranks), res


@pytest.mark.parametrize("prune", [False, True])
def test_t1_self_loop(edges, prune):
    got, res = ranks(edges(T1), max_iter=2, prune_sources=prune)
    assert got == Approx({"a": 0.15, "z": 1.85})
    first = 0.85 if prune else 1.70
    assert res.deltas == pytest.approx([first, 0.0], abs=1e-9)


def test_t1_redistribute(edges):
    got, res = ranks(edges(T1), dangling="redistribute", max_iter=1)
    assert got == Approx({"a": 0.575, "z": 1.425})
    got, res = ranks(edges(T1), dangling="redistribute", max_iter=2)
    assert got == Approx({"a": 0.755625, "z": 1.244375})
    assert res.deltas == pytest.approx([0.85, 0.36125], abs=1e-9)
    got, _ = ranks(edges(T1), dangling="redistribute", tol=1e-12, max_iter=None)
    assert got == Approx({"a": 0.701754, "z": 1.298246})


def test_t1_redistribute_pruned_lookahead(edges):
    got, res = ranks(edges(T1), dangling="redistribute", prune_sources=True, max_iter=2)
    assert got == Approx({"a": 0.755625, "z": 1.397906})
    assert res.deltas == pytest.approx([0.425, 0.027094], abs=1e-6)
    got, _ = ranks(edges(T1), dangling="redistribute", prune_sources=True, tol=1e-12, max_iter=None)
    assert got == Approx({"a": 0.701754, "z": 1.298246})


def test_t2_values(edges):
    e = edges(T2)
    assert ranks(e, max_iter=1)[0] == Approx({"1": 1.0, "2": 0.575, "3": 2.275, "4": 0.15})
    assert ranks(e, max_iter=2)[0] == Approx({"1": 0.2775, "2": 0.575, "3": 2.9975, "4": 0.15})
    assert ranks(e, max_iter=5)[0] == Approx({"1": 0.2775, "2": 0.267937, "3": 3.304562, "4": 0.15})
    red = dict(dangling="redistribute")
    assert ranks(e, max_iter=1, **red)[0] == Approx({"1": 1.2125, "2": 0.7875, "3": 1.6375, "4": 0.3625})
    assert ranks(e, max_iter=2, **red)[0] == Approx({"1": 0.806094, "2": 1.013281, "3": 1.682656, "4": 0.497969})
    assert ranks(e, tol=1e-12, max_iter=None, **red)[0] == Approx(
        {"1": 0.931895, "2": 0.899782, "3": 1.664597, "4": 0.503727}
    )
    assert ranks(e, max_iter=2, prune_sources=True, **red)[0] == Approx(
        {"1": 0.921242, "2": 1.013281, "3": 1.682656, "4": 0.497969}
    )
    assert rank(e, max_iter=1).deltas == pytest.approx([2.55])
    assert rank(e, max_iter=1, prune_sources=True).deltas == pytest.approx([1.7])


@pytest.mark.parametrize("form", FORMS)
def test_t3_cycle_stops_after_one_step(edges, form):
    got, res = ranks(edges(T3), tol=1e-9, max_iter=None, **form)
    assert got == Approx({"a": 1.0, "b": 1.0, "c": 1.0})
    assert res.iterations == 1 and res.deltas == [0.0]


def test_t4_input_self_loop_counts(edges):
    assert ranks(edges(T4), max_iter=1)[0] == Approx({"a": 0.575, "b": 1.425})
    assert ranks(edges(T4), tol=1e-12, max_iter=None)[0] == Approx({"a": 0.26087, "b": 1.73913})
    for k in (1, 2, 7):
        assert ranks(edges(T4), dangling="redistribute", max_iter=k)[0] == Approx({"a": 1.0, "b": 1.0})


def test_t6_marker_like_ids_are_plain(edges):
    marked = ranks(edges([("rank 1", "none"), ("none", "node"), ("node", "address")]), max_iter=6)[0]
    plain = ranks(edges([("w", "x"), ("x", "y"), ("y", "z")]), max_iter=6)[0]
    assert [marked[k] for k in ("rank 1", "none", "node", "address")] == pytest.approx(
        [plain[k] for k in "wxyz"], abs=1e-12
    )


@pytest.mark.parametrize("form", FORMS)
def test_t7_empty(spark, edges, form):
    res = rank(edges([]), max_iter=3, **form)
    assert res.iterations == 0 and res.ranks.count() == 0
    assert res.ranks.columns == ["vertex", "rank"]


@pytest.mark.parametrize("form", FORMS)
def test_t8_duplicates_and_order_do_not_matter(edges, form):
    once = ranks(edges(T2), max_iter=3, **form)[0]
    twice = ranks(edges(list(reversed(T2)) + T2), max_iter=3, **form)[0]
    assert Approx(once, 1e-12) == twice


def test_tolerance_is_strict_and_pruned_delta_skips_sources(edges):
    # a -> z, tol 1.0: plain L1 1.70 > 1 goes on; the pruned L1 0.85 stops at once
    assert rank(edges(T1), tol=1.0, max_iter=None).iterations == 2
    assert rank(edges(T1), tol=1.0, max_iter=None, prune_sources=True).iterations == 1
    # the loop runs while the change is above tol: first L1 is 1.70
    assert rank(edges(T1), tol=1.71, max_iter=None).iterations == 1
    assert rank(edges(T1), tol=1.69, max_iter=None).iterations == 2


def test_max_iter_caps(edges):
    res = rank(edges(T2), dangling="redistribute", tol=1e-30, max_iter=4)
    assert res.iterations == 4 and len(res.deltas) == 4


@pytest.fixture(scope="module")
def r_graph(spark):
    return returned_part_chain(spark, SF001).persist()


def test_total_rank_is_vertex_count(r_graph):
    n = r_graph.selectExpr("src AS v").union(r_graph.selectExpr("dst")).distinct().count()
    for policy in ("self_loop", "redistribute"):
        for k in (1, 4):
            df = rank(r_graph, dangling=policy, max_iter=k).ranks
            total, low = df.agg(F.sum("rank"), F.min("rank")).first()
            assert abs(total - n) < 1e-6
            assert low >= 0.15 - 1e-12


@pytest.mark.parametrize("k", [1, 2, 5])
def test_pruned_self_loop_equals_plain(r_graph, k):
    assert Approx(as_dict(rank(r_graph, max_iter=k).ranks), 1e-9) == as_dict(
        rank(r_graph, max_iter=k, prune_sources=True).ranks
    )


@pytest.mark.parametrize("form", FORMS)
def test_broadcast_and_hubs_match_shuffle(r_graph, form):
    base = Approx(as_dict(rank(r_graph, max_iter=4, **form).ranks), 1e-9)
    assert base == as_dict(rank(r_graph, max_iter=4, strategy="broadcast", **form).ranks)
    assert base == as_dict(rank(r_graph, max_iter=4, hot_threshold=3, **form).ranks)


def test_broadcast_falls_back_above_bound(r_graph):
    with pytest.warns(UserWarning):
        res = rank(r_graph, max_iter=2, strategy="broadcast", broadcast_max_vertices=10)
    assert Approx(as_dict(res.ranks), 1e-9) == as_dict(rank(r_graph, max_iter=2).ranks)


def test_partition_count_does_not_change_values(r_graph):
    a = as_dict(rank(r_graph, max_iter=3, num_partitions=3).ranks)
    b = as_dict(rank(r_graph, max_iter=3, num_partitions=7).ranks)
    assert Approx(a, 1e-9) == b


def test_redistribute_pruned_converges_to_plain(r_graph):
    a = as_dict(rank(r_graph, dangling="redistribute", tol=1e-9, max_iter=None).ranks)
    b = as_dict(rank(r_graph, dangling="redistribute", prune_sources=True, tol=1e-9, max_iter=None).ranks)
    assert Approx(a, 1e-7) == b


def test_standalone_step_matches_loop(r_graph):
    for policy in ("self_loop", "redistribute"):
        r1 = rank(r_graph, dangling=policy, max_iter=1).ranks
        r2 = rank(r_graph, dangling=policy, max_iter=2).ranks
        step = rank_step(r_graph, r1, dangling=policy)
        assert Approx(as_dict(step), 1e-9) == as_dict(r2)
        delta = rank_delta(r1, step).first().delta
        assert abs(delta - rank(r_graph, dangling=policy, max_iter=2).deltas[1]) < 1e-9


def test_contributions_and_mass(edges):
    e = edges(T2)
    r0 = e.sparkSession.createDataFrame([(v, 1.0) for v in "1234"], "vertex string, rank double")
    c = as_dict(contributions(close_dangling(e), r0), value="inflow")
    assert c == Approx({"1": 1.0, "2": 0.5, "3": 2.5})
    assert dangling_mass(e, r0).first().dangling_mass == 0.25


def test_invalid_arguments(edges):
    with pytest.raises(ValueError):
        rank(edges(T1), dangling="leak")
    with pytest.raises(ValueError):
        rank(edges(T1), strategy="nope")
    with pytest.raises(ValueError):
        rank(edges(T1), tol=None, max_iter=None)


@pytest.mark.parametrize("form", FORMS)
def test_relabelling_ids_permutes_ranks(r_graph, form):
    relabel = lambda c: F.concat(F.lit("v"), (F.col(c) * 7 + 3).cast("string"))
    renamed = r_graph.select(relabel("src").alias("src"), relabel("dst").alias("dst"))
    a = as_dict(rank(r_graph, max_iter=3, **form).ranks)
    b = as_dict(rank(renamed, max_iter=3, **form).ranks)
    assert Approx({f"v{k * 7 + 3}": v for k, v in a.items()}, 1e-9) == b


def test_no_silent_cap(edges):
    # a -> z from rank 2: after the first step z moves by 0.85 times its last move
    z, expected = [2.0, 0.15 + 0.85 * 4], 1
    while expected == 1 or abs(z[-1] - z[-2]) > 1e-9:
        z.append(0.15 + 0.85 * (0.15 + z[-1]))
        expected += 1
    full = rank(edges(T1), initial_rank=2.0, tol=1e-9)
    assert full.converged and full.iterations == expected > 64 and full.deltas[-1] <= 1e-9
    capped = rank(edges(T1), initial_rank=2.0, tol=1e-9, max_iter=5)
    assert capped.converged is False and capped.iterations == 5
    assert rank(edges(T1), max_iter=2).converged is None


def test_history_path_in_use_is_refused(r_graph, tmp_path):
    path = str(tmp_path / "h")
    rank(r_graph, max_iter=2, history_path=path)
    with pytest.raises(FileExistsError):
        rank(r_graph, max_iter=2, history_path=path)


def test_broadcast_falls_back_on_long_ids(edges, monkeypatch):
    import vertexrank.plans.layout as layout

    monkeypatch.setattr(layout, "BROADCAST_MAX_BYTES", 2000)
    long_ids = edges([("x" * 900 + a, "x" * 900 + b) for a, b in [("1", "2"), ("2", "3"), ("3", "1")]])
    with pytest.warns(UserWarning, match="exceed"):
        res = rank(long_ids, max_iter=2, strategy="broadcast")
    assert as_dict(res.ranks) == as_dict(rank(long_ids, max_iter=2).ranks)
