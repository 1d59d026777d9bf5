from vertexrank.operators import (
    adjacency,
    close_dangling,
    dangling,
    degree_table,
    graph_stats,
    out_degrees,
    source_inflow,
    sources,
    split_sources,
    vertices,
    with_in_edges,
    with_out_edges,
)

T2 = [("1", "2"), ("1", "3"), ("2", "3"), ("4", "1")]


def vset(df):
    return {r.vertex for r in df.collect()}


def test_vertex_sets(edges):
    e = edges(T2)
    assert vset(with_out_edges(e)) == {"1", "2", "4"}
    assert vset(with_in_edges(e)) == {"1", "2", "3"}
    assert vset(vertices(e)) == {"1", "2", "3", "4"}
    assert vset(dangling(e)) == {"3"}
    assert vset(sources(e)) == {"4"}


def test_degree_table_and_stats(edges):
    e = edges(T2 + [("3", "3")])
    deg = {r.vertex: (r.out_degree, r.in_degree, r.self_loops) for r in degree_table(e).collect()}
    assert deg == {"1": (2, 1, 0), "2": (1, 1, 0), "3": (1, 3, 1), "4": (1, 0, 0)}
    s = graph_stats(e).first().asDict()
    assert s == dict(n_edges=5, n_vertices=4, n_dangling=0, n_sources=1, n_self_loops=1)


def test_close_dangling_adds_self_loops(edges):
    got = {(r.src, r.dst) for r in close_dangling(edges(T2)).collect()}
    assert got == set(T2) | {("3", "3")}


def test_out_degrees(edges):
    assert {r.vertex: r.out_degree for r in out_degrees(edges(T2)).collect()} == {"1": 2, "2": 1, "4": 1}


def test_adjacency_small_lists_are_whole(edges):
    rows = adjacency(edges(T2)).collect()
    assert {r.vertex: (r.chunk, r.out_degree, r.neighbours) for r in rows} == {
        "1": (0, 2, ["2", "3"]),
        "2": (0, 1, ["3"]),
        "4": (0, 1, ["1"]),
    }


def test_adjacency_hub_is_chunked(spark):
    hub = spark.range(1000).selectExpr("0L AS src", "id + 1 AS dst")
    rows = adjacency(hub, chunk_size=100).collect()
    assert len(rows) >= 8  # about ceil(1000 / 100) chunks
    assert all(len(r.neighbours) <= 200 for r in rows)
    assert sorted(x for r in rows for x in r.neighbours) == list(range(1, 1001))
    assert {r.out_degree for r in rows} == {1000}


def test_split_sources_and_inflow(edges):
    e = edges(T2 + [("5", "1"), ("5", "3")])
    tags = {(r.src, r.dst): r.from_source for r in split_sources(e).collect()}
    assert tags[("4", "1")] and tags[("5", "3")] and not tags[("1", "2")]
    inflow = {r.vertex: r.source_in for r in source_inflow(e).collect()}
    assert inflow == {"1": 1.5, "3": 0.5}
