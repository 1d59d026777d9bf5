"""Registered queries over the benchmark tables and their DuckDB oracle SQL.

Graphs (all derived from the given tables, so their size grows with them):

* ``F``: every order as a path, customer -> first part -> ... -> last part ->
  supplier (customers are sources, suppliers dangling, parts a linked core);
* ``P``: part -> next part within an order (no dangling vertex, no source);
* ``C``: customer -> supplier (all customers are sources, all suppliers dangling).

Ranks are compared rounded to 6 decimals on both sides (summation order
changes the last bits of a double). Every computed column is aliased the same
way in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import (
    adjacency,
    close_dangling,
    compact_adjacency,
    contributions,
    dangling,
    dangling_mass,
    degree_table,
    encode_edges,
    graph_stats,
    order_ranks,
    out_degrees,
    rank,
    rank_delta,
    rank_step,
    source_inflow,
    sources,
    split_sources,
    unpack_neighbours,
    vertex_dictionary,
    vertices,
    with_in_edges,
    with_out_edges,
    with_positions,
)
from .plans.saved import open_graph, save_graph
from .session import scratch_path
from .sources.edges import edge_line_report, normalize_edges, parse_edge_lines, read_edges, store_edge_lines
from .sources.graphs import customer_supplier, load_table, order_chain, part_chain
from .sources.sinks import read_rank_history, read_ranks, write_ranks

K = 10  # fixed iteration count of the fixed-k rank queries
# Values are compared rounded to 6 decimals after adding this offset (same on
# both sides). Early-iteration ranks are short decimals such as 0.6046875 that
# sit exactly on a rounding tie, where the last bit of a sum (which depends on
# summation order) would decide the direction; the offset moves ties away.
ROUND_OFFSET = 1.23456789e-9
TOL = 1e-3  # tolerance of the rank_tolerance query (redistribute)
TOL_SELF_LOOP = 1.0  # tolerance of the rank_tolerance_self_loop query
HUB_THRESHOLD = 16  # out-degree above which a source is laid out as a hub (hub queries)

GRAPHS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "F": order_chain,
    "P": part_chain,
    "C": customer_supplier,
}


def _r6(col: str = "rank"):
    return F.round(F.col(col) + F.lit(ROUND_OFFSET), 6).alias(col)


def _ranks6(df: DataFrame) -> DataFrame:
    return df.select("vertex", _r6())


# ------------------------------------------------------------------ edge lines


def _edge_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text line per line item, in four shapes chosen by the return flag and
    line status: quoted ids, a third ignored field, plain, and malformed."""
    li = load_table(spark, sf_dir, "lineitem")
    p, s, o = (F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_orderkey"))
    q, t = F.lit('"'), F.lit("\t")
    value = (
        F.when(F.col("l_returnflag") == "R", F.concat(q, q, p, q, q, t, q, s, q))
        .when(F.col("l_returnflag") == "A", F.concat(p, t, s, t, o))
        .when(F.col("l_linestatus") == "O", F.concat(p, t, s))
        .otherwise(F.concat(p, t))
    )
    return li.select(value.alias("value"))


_LINES_SQL = r"""(SELECT CASE
    WHEN l_returnflag = 'R' THEN '""' || l_partkey || '""' || chr(9) || '"' || l_suppkey || '"'
    WHEN l_returnflag = 'A' THEN l_partkey || chr(9) || l_suppkey || chr(9) || l_orderkey
    WHEN l_linestatus = 'O' THEN l_partkey || chr(9) || l_suppkey
    ELSE l_partkey || chr(9) END AS value FROM lineitem)"""

_FIELDS_SQL = f"(SELECT string_split(rtrim(value, chr(9)), chr(9)) AS f FROM {_LINES_SQL})"

_PARSED_SQL = (
    "(SELECT trim(f[1], '\"') AS src, trim(f[2], '\"') AS dst "
    f"FROM {_FIELDS_SQL} WHERE len(f) >= 2)"
)


def q_parse_edge_lines(spark, sf_dir):
    return parse_edge_lines(_edge_text_lines(spark, sf_dir))


def q_edge_line_report(spark, sf_dir):
    return edge_line_report(_edge_text_lines(spark, sf_dir))


def q_normalize_edges(spark, sf_dir):
    return normalize_edges(parse_edge_lines(_edge_text_lines(spark, sf_dir)))


def q_read_edges_text(spark, sf_dir):
    """The F graph written as a text edge list (quoted source, plain target, a
    third field to ignore), then read back with ``read_edges``."""
    path = scratch_path(spark, "edges-text")
    q, t = F.lit('"'), F.lit("\t")
    line = F.concat(q, F.col("src").cast("string"), q, t, F.col("dst").cast("string"), t, F.lit("x"))
    order_chain(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_edges(spark, path)


def q_stored_edges(spark, sf_dir):
    return store_edge_lines(_edge_text_lines(spark, sf_dir), scratch_path(spark, "lines"))[0]


def q_edge_rejects(spark, sf_dir):
    return store_edge_lines(_edge_text_lines(spark, sf_dir), scratch_path(spark, "lines"))[1]


# ------------------------------------------------------------------ graph SQL

_CHAIN_SQL = """SELECT DISTINCT src, dst FROM (
  SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst
  FROM lineitem {where})
WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> 0 AND dst <> 0"""

GRAPH_SQL = {
    "F": """SELECT DISTINCT src, dst FROM (
  SELECT 'p' || l_partkey AS src, 'p' || lead(l_partkey) OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst
  FROM lineitem
  UNION ALL
  SELECT 'c' || o_custkey, 'p' || a.l_partkey FROM orders
  JOIN (SELECT l_orderkey, min(struct_pack(n := l_linenumber, l_partkey := l_partkey, s := l_suppkey)) AS a FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
  UNION ALL
  SELECT 'p' || z.l_partkey, 's' || z.l_suppkey FROM
       (SELECT max(struct_pack(n := l_linenumber, l_partkey := l_partkey, l_suppkey := l_suppkey)) AS z FROM lineitem GROUP BY l_orderkey))
WHERE src IS NOT NULL AND dst IS NOT NULL""",
    "P": _CHAIN_SQL.format(where=""),
    "C": """SELECT DISTINCT 'c' || o_custkey AS src, 's' || l_suppkey AS dst
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_custkey IS NOT NULL AND l_suppkey IS NOT NULL""",
}


def _with_graph(g: str, body: str) -> str:
    return (
        f"WITH e AS MATERIALIZED ({GRAPH_SQL[g]}),\n"
        "v AS MATERIALIZED (SELECT src AS v FROM e UNION SELECT dst FROM e)\n" + body
    )


# Recursive templates. ``{E}`` graph, ``{K}`` steps. The plain forms (self-loop,
# redistribute) iterate every vertex; the look-ahead form reproduces factored
# sources under redistribution.
_RANK_HEAD = """WITH RECURSIVE e AS MATERIALIZED ({E}),
v AS MATERIALIZED (SELECT src AS v FROM e UNION SELECT dst FROM e),
e2 AS MATERIALIZED ({E2}),
w AS MATERIALIZED (SELECT src, 1.0::DOUBLE / count(*) AS w FROM e2 GROUP BY src),
n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM v),
f AS MATERIALIZED (SELECT v, v NOT IN (SELECT src FROM e) AS dang,
                          v NOT IN (SELECT dst FROM e) AS source FROM v)"""

_E2_SELF_LOOP = "SELECT src, dst FROM e UNION ALL SELECT v, v FROM v WHERE v NOT IN (SELECT src FROM e)"
_E2_PLAIN = "SELECT src, dst FROM e"
_MASS = "coalesce((SELECT sum(q.rank) FROM r q JOIN f h ON h.v = q.v WHERE h.dang), 0) / (SELECT n FROM n)"

_INFLOW = """(SELECT e2.dst, sum(p.rank * w.w) AS c
            FROM r p JOIN w ON w.src = p.v JOIN e2 ON e2.src = p.v GROUP BY e2.dst)"""


def _plain_rank_cte(g: str, policy: str, k: int) -> str:
    e2 = _E2_SELF_LOOP if policy == "self_loop" else _E2_PLAIN
    m = "0" if policy == "self_loop" else _MASS
    return (
        _RANK_HEAD.format(E=GRAPH_SQL[g], E2=e2)
        + f""",
r(k, v, rank) AS (
  SELECT 0, v, 1.0::DOUBLE FROM v
  UNION ALL
  SELECT s.k + 1, s.v, 0.15 + 0.85 * coalesce(i.c, 0) + 0.85 * {m}
  FROM r s LEFT JOIN {_INFLOW} i ON i.dst = s.v
  WHERE s.k < {k})
"""
    )


def _lookahead_rank_cte(g: str, k: int) -> str:
    return (
        _RANK_HEAD.format(E=GRAPH_SQL[g], E2=_E2_PLAIN)
        + f""",
r(k, v, rank) AS (
  SELECT 0, v, 1.0::DOUBLE FROM v
  UNION ALL
  SELECT s.k + 1, s.v, 0.15 + 0.85 * mm.m + 0.85 * coalesce(i.c, 0)
  FROM r s
  CROSS JOIN (SELECT coalesce(sum(p.rank) FILTER (WHERE f.dang), 0) / (SELECT n FROM n) AS m
              FROM r p JOIN f ON f.v = p.v) mm
  LEFT JOIN (SELECT e2.dst, sum(w.w * CASE WHEN NOT f.source THEN p.rank
                                           WHEN p.k = 0 THEN 1.0 ELSE 0.15 + 0.85 * g.m END) AS c
             FROM r p JOIN f ON f.v = p.v JOIN w ON w.src = p.v JOIN e2 ON e2.src = p.v
             CROSS JOIN (SELECT coalesce(sum(q.rank) FILTER (WHERE h.dang), 0) / (SELECT n FROM n) AS m
                         FROM r q JOIN f h ON h.v = q.v) g
             GROUP BY e2.dst) i ON i.dst = s.v
  WHERE s.k < {k})
"""
    )


def _rank_at_sql(cte: str, k: int) -> str:
    return cte + f"SELECT v AS vertex, R6(rank) AS rank FROM r WHERE k = {k}"


def _lookahead_tolerance_sql(g: str, policy: str, tol: float, cap: int = 400) -> str:
    """Pruned forms stop by the change of the vertices that are no sources."""
    if policy == "self_loop":
        cte = _plain_rank_cte(g, "self_loop", cap)
    else:
        cte = _lookahead_rank_cte(g, cap)
    return (
        cte
        + f""", d AS (SELECT a.k, sum(abs(a.rank - b.rank)) AS delta FROM r a JOIN r b ON a.v = b.v AND b.k = a.k - 1
  JOIN f ON f.v = a.v WHERE NOT f.source GROUP BY a.k),
s AS (SELECT min(k) AS k FROM d WHERE delta <= {tol!r})
SELECT v AS vertex, CAST(r.k AS BIGINT) AS iterations, R6(rank) AS rank FROM r JOIN s ON r.k = s.k"""
    )


def _tolerance_sql(g: str, policy: str, tol: float, cap: int = 10**9) -> str:
    e2 = _E2_SELF_LOOP if policy == "self_loop" else _E2_PLAIN
    m = "0" if policy == "self_loop" else _MASS
    return (
        _RANK_HEAD.format(E=GRAPH_SQL[g], E2=e2)
        + f""",
r(k, v, rank, delta) AS (
  SELECT 0, v, 1.0::DOUBLE, 1e300::DOUBLE FROM v
  UNION ALL
  SELECT k + 1, v, nr, sum(abs(nr - rank)) OVER () FROM (
    SELECT s.k, s.v, s.rank, 0.15 + 0.85 * coalesce(i.c, 0) + 0.85 * {m} AS nr
    FROM r s LEFT JOIN {_INFLOW} i ON i.dst = s.v
    WHERE s.delta > {tol!r} AND s.k < {cap}))
SELECT v AS vertex, CAST(k AS BIGINT) AS iterations, R6(rank) AS rank
FROM r WHERE k = (SELECT max(k) FROM r)"""
    )


# ------------------------------------------------------------------ Spark queries


def _graph(g: str):
    return GRAPHS[g]


def _rank_query(g: str, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _ranks6(rank(_graph(g)(spark, sf_dir), distinct=True, **kw).ranks)

    return run


def q_rank_tolerance(spark, sf_dir):
    res = rank(order_chain(spark, sf_dir), distinct=True, dangling="redistribute", tol=TOL)
    return res.ranks.select("vertex", F.lit(res.iterations).cast("long").alias("iterations"), _r6())


def q_rank_tolerance_self_loop(spark, sf_dir):
    res = rank(order_chain(spark, sf_dir), distinct=True, tol=TOL_SELF_LOOP, max_iter=None)
    return res.ranks.select("vertex", F.lit(res.iterations).cast("long").alias("iterations"), _r6())


def _ranks_after_one(spark, sf_dir, policy):
    edges = order_chain(spark, sf_dir)
    return edges, rank(edges, distinct=True, dangling=policy, max_iter=1).ranks


def q_contributions(spark, sf_dir):
    edges, r1 = _ranks_after_one(spark, sf_dir, "self_loop")
    return contributions(close_dangling(edges), r1).select("vertex", _r6("inflow"))


def q_rank_step(spark, sf_dir):
    edges, r1 = _ranks_after_one(spark, sf_dir, "redistribute")
    return _ranks6(rank_step(edges, r1, dangling="redistribute"))


def q_dangling_mass(spark, sf_dir):
    edges, r1 = _ranks_after_one(spark, sf_dir, "redistribute")
    return dangling_mass(edges, r1).select(_r6("dangling_mass"))


def q_rank_delta(spark, sf_dir):
    edges, r1 = _ranks_after_one(spark, sf_dir, "redistribute")
    r2 = rank_step(edges, r1, dangling="redistribute")
    return rank_delta(r1, r2).select(_r6("delta"))


def q_rank_positions(spark, sf_dir):
    ranks = _ranks6(rank(order_chain(spark, sf_dir), distinct=True, max_iter=K).ranks)
    return with_positions(ranks)


def q_order_ranks(spark, sf_dir):
    """Sorted ranks written out; the position of a row is its place in the files
    taken in name order."""
    path = scratch_path(spark, "ordered")
    order_ranks(_ranks6(rank(order_chain(spark, sf_dir), distinct=True, max_iter=K).ranks)).write.parquet(path)
    back = spark.read.parquet(path).select("vertex", "rank", "_metadata.file_name", "_metadata.row_index")
    sizes = back.groupBy("file_name").agg(F.count("*").alias("n"))  # one row per file
    before = sizes.select("file_name", (F.sum("n").over(Window.orderBy("file_name")) - F.col("n")).alias("before"))
    return back.join(F.broadcast(before), "file_name").select(
        "vertex", "rank", (F.col("before") + F.col("row_index") + 1).cast("long").alias("position")
    )


def _rank_to(tol: float, **kw):
    def run(spark, sf_dir):
        res = rank(order_chain(spark, sf_dir), distinct=True, tol=tol, **kw)
        return res.ranks.select("vertex", F.lit(res.iterations).cast("long").alias("iterations"), _r6())

    return run


def q_write_ranks_roundtrip(spark, sf_dir):
    ranks = rank(order_chain(spark, sf_dir), distinct=True, max_iter=K).ranks
    out = []
    for fmt in ("tuple", "tsv"):
        path = scratch_path(spark, f"ranks-{fmt}")
        write_ranks(ranks, path, fmt=fmt)
        back = read_ranks(spark, path, fmt=fmt, vertex_type="string")
        out.append(back.select(F.lit(fmt).alias("fmt"), "vertex", _r6()))
    return out[0].unionByName(out[1])


def q_rank_history(spark, sf_dir):
    path = scratch_path(spark, "history")
    rank(order_chain(spark, sf_dir), distinct=True, max_iter=K, history_path=path)
    return read_rank_history(spark, path).select("iteration", "vertex", _r6())


def q_rank_resumed(spark, sf_dir, **kw):
    """Stopped after half of the steps, then resumed; every iteration of both runs."""
    path = scratch_path(spark, "resumed")
    edges = order_chain(spark, sf_dir)
    rank(edges, distinct=True, max_iter=K // 2, history_path=path, **kw)
    rank(edges, distinct=True, max_iter=K, history_path=path, resume=True, **kw)
    return read_rank_history(spark, path).select("iteration", "vertex", _r6())


def _saved_rank_query(g: str, hot_threshold: int | None = None, **kw):
    """Laid out on disk, opened again, and ranked twice from there: the second run."""

    def run(spark, sf_dir):
        path = scratch_path(spark, "graph")
        save_graph(_graph(g)(spark, sf_dir), path, hot_threshold=hot_threshold, distinct=True)
        rank(open_graph(spark, path), max_iter=1, **kw)
        return _ranks6(rank(open_graph(spark, path), max_iter=K, **kw).ranks)

    return run


def q_rank_order_free(spark, sf_dir):
    """Run on two layouts with sums that do not depend on them: rows of either
    that the other has not to the last bit would be missing here."""
    edges = order_chain(spark, sf_dir)
    a, b = (rank(edges, distinct=True, dangling="redistribute", tol=TOL, order_free=True, num_partitions=n, hot_threshold=h) for n, h in ((3, None), (11, HUB_THRESHOLD)))
    both = a.ranks.join(b.ranks, ["vertex", "rank"]) if a.deltas == b.deltas else a.ranks.limit(0)
    return both.select("vertex", F.lit(a.iterations).cast("long").alias("iterations"), _r6())


def q_compact_adjacency(spark, sf_dir):
    edges = order_chain(spark, sf_dir)
    names = vertex_dictionary(edges)
    lists = unpack_neighbours(compact_adjacency(encode_edges(edges, names), names.count(), chunk_size=64))
    whole = lists.groupBy("vertex", "out_degree").agg(F.array_sort(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    return whole.select("vertex", "out_degree", F.array_join("neighbours", ",").alias("neighbours"))


def q_ranks_in_part_files(spark, sf_dir):
    """Sorted ranks in text files of a set size: a row's position is its place in
    the files taken in name order."""
    path = scratch_path(spark, "parts")
    ranks = _ranks6(rank(order_chain(spark, sf_dir), distinct=True, max_iter=K).ranks)
    write_ranks(ranks, path, fmt="parquet", part_bytes=8192)
    back = spark.read.parquet(path).select("vertex", "rank", "_metadata.file_name", "_metadata.row_index")
    sizes = back.groupBy("file_name").agg(F.count("*").alias("n"))  # one row per file
    before = sizes.select("file_name", (F.sum("n").over(Window.orderBy("file_name")) - F.col("n")).alias("before"))
    return back.join(F.broadcast(before), "file_name").select(
        "vertex", "rank", (F.col("before") + F.col("row_index") + 1).cast("long").alias("position")
    )


def _topo(g: str, fn, post=None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(_graph(g)(spark, sf_dir))
        return post(df) if post else df

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources / edge rules
    "parse_edge_lines": q_parse_edge_lines,
    "edge_line_report": q_edge_line_report,
    "normalize_edges": q_normalize_edges,
    "read_edges_text": q_read_edges_text,
    "stored_edges": q_stored_edges,
    "edge_rejects": q_edge_rejects,
    # dense ids
    "vertex_dictionary": _topo("F", vertex_dictionary),
    "encode_edges": _topo("F", lambda e: encode_edges(e, vertex_dictionary(e))),
    "compact_adjacency": q_compact_adjacency,
    "rank_self_loop_dense": _rank_query("F", max_iter=K, dense_ids=True),
    "rank_redistribute_pruned_dense_hubs": _rank_query(
        "F", dangling="redistribute", prune_sources=True, max_iter=K, dense_ids=True, hot_threshold=HUB_THRESHOLD
    ),
    # a graph on disk, a run resumed, sums without an order
    "rank_saved_graph": _saved_rank_query("F"),
    "rank_saved_graph_pruned_hubs": _saved_rank_query("F", HUB_THRESHOLD, dangling="redistribute", prune_sources=True),
    "rank_saved_graph_c": _saved_rank_query("C", dangling="redistribute"),
    "rank_resumed": q_rank_resumed,
    "rank_resumed_pruned": lambda spark, sf_dir: q_rank_resumed(spark, sf_dir, dangling="redistribute", prune_sources=True),
    "rank_order_free": q_rank_order_free,
    # topology
    "with_out_edges": _topo("F", with_out_edges),
    "with_in_edges": _topo("F", with_in_edges),
    "vertices": _topo("F", vertices),
    "dangling": _topo("F", dangling),
    "sources": _topo("F", sources),
    "close_dangling": _topo("F", close_dangling),
    "out_degrees": _topo("F", out_degrees),
    "degree_table": _topo("F", degree_table),
    "adjacency": _topo(
        "F",
        adjacency,
        lambda df: df.select(
            "vertex", "chunk", "out_degree", F.array_join("neighbours", ",").alias("neighbours")
        ),
    ),
    "adjacency_chunked": _topo(
        "F",
        lambda e: adjacency(e, chunk_size=4),
        lambda df: df.groupBy("vertex", "out_degree").agg(
            F.array_join(F.array_sort(F.flatten(F.collect_list("neighbours"))), ",").alias("neighbours")
        ),
    ),
    "graph_stats": _topo("F", graph_stats),
    "graph_stats_c": _topo("C", graph_stats),
    "graph_stats_p": _topo("P", graph_stats),
    "split_sources": _topo("F", split_sources),
    "source_inflow": _topo("F", source_inflow, lambda df: df.select("vertex", _r6("source_in"))),
    "source_inflow_c": _topo("C", source_inflow, lambda df: df.select("vertex", _r6("source_in"))),
    # one step
    "contributions": q_contributions,
    "rank_step": q_rank_step,
    "dangling_mass": q_dangling_mass,
    "rank_delta": q_rank_delta,
    # full rank
    "rank_self_loop": _rank_query("F", max_iter=K),
    "rank_redistribute": _rank_query("F", dangling="redistribute", max_iter=K),
    "rank_self_loop_pruned": _rank_query("F", prune_sources=True, max_iter=K),
    "rank_redistribute_pruned": _rank_query("F", dangling="redistribute", prune_sources=True, max_iter=K),
    "rank_broadcast": _rank_query("F", strategy="broadcast", max_iter=K),
    "rank_tolerance": q_rank_tolerance,
    "rank_redistribute_1e6": _rank_to(1e-6, dangling="redistribute"),
    "rank_self_loop_1e6": _rank_to(1e-6),
    "rank_tolerance_pruned": _rank_to(TOL, dangling="redistribute", prune_sources=True),
    "rank_tolerance_self_loop_pruned": _rank_to(TOL_SELF_LOOP, prune_sources=True),
    "rank_redistribute_pruned_hubs": _rank_query(
        "F", dangling="redistribute", prune_sources=True, max_iter=K, hot_threshold=HUB_THRESHOLD
    ),
    "rank_broadcast_pruned": _rank_query(
        "F", dangling="redistribute", prune_sources=True, strategy="broadcast", max_iter=K
    ),
    "rank_tolerance_self_loop": q_rank_tolerance_self_loop,
    "rank_self_loop_c": _rank_query("C", max_iter=K),
    "rank_redistribute_c": _rank_query("C", dangling="redistribute", max_iter=K),
    "rank_self_loop_pruned_c": _rank_query("C", prune_sources=True, max_iter=K),
    "rank_redistribute_pruned_c": _rank_query("C", dangling="redistribute", prune_sources=True, max_iter=K),
    "rank_redistribute_p": _rank_query("P", dangling="redistribute", max_iter=K),
    "rank_redistribute_pruned_p": _rank_query("P", dangling="redistribute", prune_sources=True, max_iter=K),
    "rank_broadcast_pruned_c": _rank_query(
        "C", dangling="redistribute", prune_sources=True, strategy="broadcast", max_iter=K
    ),
    "rank_self_loop_hubs_p": _rank_query("P", max_iter=K, hot_threshold=HUB_THRESHOLD),
    "rank_redistribute_pruned_hubs_c": _rank_query(
        "C", dangling="redistribute", prune_sources=True, max_iter=K, hot_threshold=HUB_THRESHOLD
    ),
    # order and sinks
    "order_ranks": q_order_ranks,
    "rank_positions": q_rank_positions,
    "ranks_in_part_files": q_ranks_in_part_files,
    "write_ranks_roundtrip": q_write_ranks_roundtrip,
    "rank_history": q_rank_history,
}


# ------------------------------------------------------------------ oracle SQL


def _oracle() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["parse_edge_lines"] = f"SELECT src, dst FROM {_PARSED_SQL}"
    sql["edge_line_report"] = f"""SELECT count(*) AS n_lines,
  count(*) FILTER (WHERE len(f) < 2) AS n_malformed,
  count(*) FILTER (WHERE len(f) >= 2) AS n_parsed,
  count(*) FILTER (WHERE len(f) >= 2 AND (trim(f[1], '"') = '0' OR trim(f[2], '"') = '0')) AS n_sentinel
FROM {_FIELDS_SQL}"""
    sql["normalize_edges"] = f"SELECT DISTINCT src, dst FROM {_PARSED_SQL} WHERE src <> '0' AND dst <> '0'"

    sql["stored_edges"] = sql["normalize_edges"]
    sql["edge_rejects"] = f"""SELECT value, CASE WHEN len(f) < 2 THEN 'malformed' ELSE 'sentinel' END AS problem
FROM (SELECT value, string_split(rtrim(value, chr(9)), chr(9)) AS f FROM {_LINES_SQL})
WHERE len(f) < 2 OR trim(f[1], '"') = '0' OR trim(f[2], '"') = '0'"""
    ids = "i AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY v) - 1 AS id FROM v)"
    with_ids = lambda body: _with_graph("F", "").rstrip() + f",\n{ids}\n{body}"
    sql["vertex_dictionary"] = with_ids("""SELECT v AS vertex, id, coalesce(o.n, 0) AS out_degree, coalesce(t.n, 0) AS in_degree FROM i
LEFT JOIN (SELECT src AS v, count(*) AS n FROM e GROUP BY src) o USING (v) LEFT JOIN (SELECT dst AS v, count(*) AS n FROM e GROUP BY dst) t USING (v)""")
    sql["encode_edges"] = with_ids("SELECT a.id AS src, b.id AS dst FROM e JOIN i a ON a.v = e.src JOIN i b ON b.v = e.dst")
    sql["compact_adjacency"] = with_ids("""SELECT a.id AS vertex, count(*) AS out_degree, string_agg(CAST(b.id AS VARCHAR), ',' ORDER BY b.id) AS neighbours
FROM e JOIN i a ON a.v = e.src JOIN i b ON b.v = e.dst GROUP BY a.id""")
    sql["read_edges_text"] = _with_graph(
        "F", "SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM e"
    )
    sql["with_out_edges"] = _with_graph("F", "SELECT DISTINCT src AS vertex FROM e")
    sql["with_in_edges"] = _with_graph("F", "SELECT DISTINCT dst AS vertex FROM e")
    sql["vertices"] = _with_graph("F", "SELECT v AS vertex FROM v")
    sql["dangling"] = _with_graph("F", "SELECT v AS vertex FROM v WHERE v NOT IN (SELECT src FROM e)")
    sql["sources"] = _with_graph("F", "SELECT v AS vertex FROM v WHERE v NOT IN (SELECT dst FROM e)")
    sql["close_dangling"] = _with_graph(
        "F", "SELECT src, dst FROM e UNION ALL SELECT v, v FROM v WHERE v NOT IN (SELECT src FROM e)"
    )
    sql["out_degrees"] = _with_graph("F", "SELECT src AS vertex, count(*) AS out_degree FROM e GROUP BY src")
    sql["degree_table"] = _with_graph(
        "F",
        """SELECT v AS vertex,
  (SELECT count(*) FROM e WHERE e.src = v.v) AS out_degree,
  (SELECT count(*) FROM e WHERE e.dst = v.v) AS in_degree,
  (SELECT count(*) FROM e WHERE e.src = v.v AND e.dst = v.v) AS self_loops
FROM v""",
    )
    sql["adjacency"] = _with_graph(
        "F",
        """SELECT src AS vertex, CAST(0 AS BIGINT) AS chunk, count(*) AS out_degree,
  string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours
FROM e GROUP BY src""",
    )
    sql["adjacency_chunked"] = _with_graph(
        "F",
        """SELECT src AS vertex, count(*) AS out_degree, string_agg(CAST(dst AS VARCHAR), ',' ORDER BY dst) AS neighbours
FROM e GROUP BY src""",
    )
    stats = """SELECT (SELECT count(*) FROM e) AS n_edges, (SELECT count(*) FROM v) AS n_vertices,
  (SELECT count(*) FROM v WHERE v NOT IN (SELECT src FROM e)) AS n_dangling,
  (SELECT count(*) FROM v WHERE v NOT IN (SELECT dst FROM e)) AS n_sources,
  (SELECT count(*) FROM e WHERE src = dst) AS n_self_loops"""
    for g, name in (("F", "graph_stats"), ("C", "graph_stats_c"), ("P", "graph_stats_p")):
        sql[name] = _with_graph(g, stats)
    sql["split_sources"] = _with_graph(
        "F",
        """SELECT e.src, e.dst, t.v IS NULL AS from_source
FROM e LEFT JOIN (SELECT DISTINCT dst AS v FROM e) t ON t.v = e.src""",
    )
    inflow = """SELECT e.dst AS vertex, R6(sum(1.0::DOUBLE / d.deg)) AS source_in
FROM e JOIN (SELECT src, count(*) AS deg FROM e GROUP BY src) d ON d.src = e.src
WHERE e.src NOT IN (SELECT dst FROM e) GROUP BY e.dst"""
    sql["source_inflow"] = _with_graph("F", inflow)
    sql["source_inflow_c"] = _with_graph("C", inflow)

    self_loop_2 = _plain_rank_cte("F", "self_loop", 2)
    sql["contributions"] = self_loop_2 + (
        "SELECT e2.dst AS vertex, R6(sum(p.rank * w.w)) AS inflow "
        "FROM r p JOIN w ON w.src = p.v JOIN e2 ON e2.src = p.v WHERE p.k = 1 GROUP BY e2.dst"
    )
    redist_2 = _plain_rank_cte("F", "redistribute", 2)
    sql["rank_step"] = _rank_at_sql(redist_2, 2)
    sql["dangling_mass"] = redist_2 + (
        "SELECT R6(coalesce(sum(r.rank) FILTER (WHERE f.dang), 0) / (SELECT n FROM n)) "
        "AS dangling_mass FROM r JOIN f ON f.v = r.v WHERE r.k = 1"
    )
    sql["rank_delta"] = redist_2 + (
        "SELECT R6(sum(abs(a.rank - b.rank))) AS delta "
        "FROM r a JOIN r b ON a.v = b.v WHERE a.k = 1 AND b.k = 2"
    )

    for g, sfx in (("F", ""), ("C", "_c"), ("P", "_p")):
        sl = _rank_at_sql(_plain_rank_cte(g, "self_loop", K), K)
        rd = _rank_at_sql(_plain_rank_cte(g, "redistribute", K), K)
        la = _rank_at_sql(_lookahead_rank_cte(g, K), K)
        if g in ("F", "C"):
            sql[f"rank_self_loop{sfx}"] = sl
            sql[f"rank_redistribute{sfx}"] = rd
            sql[f"rank_self_loop_pruned{sfx}"] = sl  # same ranks at every step
            sql[f"rank_redistribute_pruned{sfx}"] = la
        if g == "F":
            sql["rank_broadcast"] = sl
            sql["rank_redistribute_pruned_hubs"] = la
            sql["rank_broadcast_pruned"] = la
            sql["rank_self_loop_dense"] = sql["rank_saved_graph"] = sl
            sql["rank_redistribute_pruned_dense_hubs"] = sql["rank_saved_graph_pruned_hubs"] = la
        if g == "C":
            sql["rank_redistribute_pruned_hubs_c"] = la
            sql["rank_broadcast_pruned_c"] = la
            sql["rank_saved_graph_c"] = rd
        if g == "P":
            sql["rank_redistribute_p"] = rd
            sql["rank_redistribute_pruned_p"] = la
            sql["rank_self_loop_hubs_p"] = sl
    sql["rank_tolerance"] = _tolerance_sql("F", "redistribute", TOL)
    sql["rank_tolerance_self_loop"] = _tolerance_sql("F", "self_loop", TOL_SELF_LOOP)
    sql["rank_redistribute_1e6"] = _tolerance_sql("F", "redistribute", 1e-6)
    sql["rank_self_loop_1e6"] = _tolerance_sql("F", "self_loop", 1e-6)
    sql["rank_tolerance_pruned"] = _lookahead_tolerance_sql("F", "redistribute", TOL, cap=90)
    sql["rank_tolerance_self_loop_pruned"] = _lookahead_tolerance_sql("F", "self_loop", TOL_SELF_LOOP, cap=60)

    sl_r = _plain_rank_cte("F", "self_loop", K)
    sql["order_ranks"] = sl_r + (
        "SELECT vertex, rank, row_number() OVER (ORDER BY rank, vertex) AS position FROM "
        f"(SELECT v AS vertex, R6(rank) AS rank FROM r WHERE k = {K})"
    )
    sql["rank_positions"] = sql["ranks_in_part_files"] = sql["order_ranks"]
    sql["write_ranks_roundtrip"] = sl_r + (
        "SELECT fmt, v AS vertex, R6(rank) AS rank FROM r "
        f"CROSS JOIN (VALUES ('tuple'), ('tsv')) t(fmt) WHERE k = {K}"
    )
    sql["rank_history"] = sl_r + "SELECT CAST(k AS INTEGER) AS iteration, v AS vertex, R6(rank) AS rank FROM r"
    sql["rank_resumed"] = sql["rank_history"]
    look_ahead = _lookahead_rank_cte("F", K)
    sql["rank_resumed_pruned"] = look_ahead + "SELECT CAST(k AS INTEGER) AS iteration, v AS vertex, R6(rank) AS rank FROM r"
    sql["rank_order_free"] = sql["rank_tolerance"]
    return sql


def _expand_r6(sql: str) -> str:
    """Rewrite every ``R6(expr)`` into ``round((expr) + ROUND_OFFSET, 6)``."""
    out, i = [], 0
    while (j := sql.find("R6(", i)) >= 0:
        depth, k = 1, j + 3
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + f"round(({_expand_r6(sql[j + 3:k - 1])}) + {ROUND_OFFSET!r}, 6)")
        i = k
    return "".join(out) + sql[i:]


ORACLE_SQL = {name: _expand_r6(sql) for name, sql in _oracle().items()}
